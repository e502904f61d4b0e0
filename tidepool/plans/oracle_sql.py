"""DuckDB text of the swap-like view and its rated columns.

The Spark side computes exact rationals and resolves them once; the SQL
side keeps integer numerators (cents, fees in millionths, gas units) so each
published double is one correctly rounded division of exact integers where
the view allows it. Where two roundings cannot be avoided (a conversion of
a converted amount, a double sum), both sides round the result the same way.
"""

# swap rows; pool = user_id % 12, price1 = v / 100 with v in cents
SWAP_TEMPLATE = """
ev AS (
  SELECT event_id, event_id AS logId, user_id, user_id % 12 AS p,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         CAST(round(value * 100) AS BIGINT) AS v,
         CAST(floor(epoch(ts)) AS BIGINT) AS timestamp,
         strftime(ts, '%Y-%m-%d') AS date, event_type
  FROM events),
sw AS (
  SELECT *, 'A' || CAST(p AS VARCHAR) AS address,
         CASE WHEN p % 4 = 0 THEN (CASE WHEN p = 4 THEN 'T' || CAST(1 + p // 4 AS VARCHAR) ELSE 'ETH' END)
              WHEN p % 4 = 1 THEN 'ETH' ELSE 'T' || CAST(p % 5 AS VARCHAR) END AS t0,
         CASE WHEN p % 4 = 0 THEN (CASE WHEN p = 4 THEN 'ETH' ELSE 'T' || CAST(1 + p // 4 AS VARCHAR) END)
              WHEN p % 4 = 1 THEN 'T0' ELSE 'T' || CAST((p + 2) % 5 AS VARCHAR) END AS t1,
         [500, 3000, 10000][p % 3 + 1] AS fee, [10, 60, 200][p % 3 + 1] AS tickSpacing,
         k - 50 AS tick, CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END AS sd, user_id % 3 + 1 AS mult,
         k + 21 AS gas, user_id + 1 AS gp, event_id % 10 <> 0 AS has_bf
  FROM ev),
prep AS (
  SELECT *, 'ETH' IN (t0, t1) AS isBasePool,
         CASE WHEN 'ETH' IN (t0, t1) THEN t1 = 'ETH' END AS is1,
         CASE WHEN 'ETH' IN (t0, t1) THEN (CASE WHEN t1 = 'ETH' THEN t0 ELSE t1 END) ELSE t0 END AS pt0,
         CASE WHEN 'ETH' IN (t0, t1) THEN (CASE WHEN t1 = 'ETH' THEN t0 ELSE t1 END) ELSE t1 END AS pt1,
         concat_ws('_', t0, t1, CAST(fee // 100 AS INTEGER)) AS pool, t0 || '_' || t1 AS pair,
         CASE WHEN sd > 0 THEN v * fee ELSE 0 END AS F0,
         CASE WHEN sd < 0 THEN v * mult * fee ELSE 0 END AS F1,
         v * sd * 1000000 - (CASE WHEN sd > 0 THEN v * fee ELSE 0 END) AS N0,
         -v * sd * mult * 1000000 - (CASE WHEN sd < 0 THEN v * mult * fee ELSE 0 END) AS N1
  FROM sw),
tl AS (
  SELECT *, CAST(v AS DOUBLE) AS liq, 1.0 + (k % 7) / 1000.0 AS sp,
         pow(1.0001, (floor(tick / tickSpacing) * tickSpacing) / 2) AS lo,
         pow(1.0001, (floor(tick / tickSpacing) * tickSpacing + tickSpacing) / 2) AS up
  FROM prep),
dl AS (
  SELECT *, (CAST(v AS DOUBLE) * (up - lo)) / (lo * up) / 100.0 AS tickDepth0,
         (CAST(v AS DOUBLE) * (up - lo)) / 100.0 AS tickDepth1,
         lag(v) OVER w AS pv0, lag(k) OVER w AS pk0, lag(logId) OVER w AS pid
  FROM tl WINDOW w AS (PARTITION BY p ORDER BY logId)),
dlt AS (
  SELECT *, CASE WHEN logId - pid <= {delta_x} THEN pv0 END AS pv, CASE WHEN logId - pid <= {delta_x} THEN pk0 END AS pk
  FROM dl),
q AS (SELECT logId AS qid, pt0 AS tok, address AS qaddr, v AS qv, is1 AS qis1 FROM prep WHERE isBasePool),
uq AS (SELECT logId AS uid, address AS uaddr, v AS uv, is1 AS uis1 FROM prep WHERE isBasePool AND 'T0' IN (t0, t1)),
aq AS (
  SELECT s.*,
         CASE WHEN NOT s.isBasePool AND s.logId - q0.qid <= {base_x} THEN q0.qid END AS b0id,
         CASE WHEN NOT s.isBasePool AND s.logId - q0.qid <= {base_x} THEN q0.qaddr END AS b0addr,
         CASE WHEN NOT s.isBasePool AND s.logId - q0.qid <= {base_x} THEN q0.qv END AS b0v,
         CASE WHEN NOT s.isBasePool AND s.logId - q0.qid <= {base_x} THEN q0.qis1 END AS b0is1
  FROM dlt s ASOF LEFT JOIN q q0 ON s.pt0 = q0.tok AND s.logId > q0.qid),
aq1 AS (
  SELECT s.*,
         CASE WHEN NOT s.isBasePool AND s.logId - q1.qid <= {base_x} THEN q1.qid END AS b1id,
         CASE WHEN NOT s.isBasePool AND s.logId - q1.qid <= {base_x} THEN q1.qaddr END AS b1addr,
         CASE WHEN NOT s.isBasePool AND s.logId - q1.qid <= {base_x} THEN q1.qv END AS b1v,
         CASE WHEN NOT s.isBasePool AND s.logId - q1.qid <= {base_x} THEN q1.qis1 END AS b1is1
  FROM aq s ASOF LEFT JOIN q q1 ON s.pt1 = q1.tok AND s.logId > q1.qid),
au AS (
  SELECT s.*,
         CASE WHEN NOT (s.isBasePool AND 'T0' IN (s.t0, s.t1)) AND s.logId - u.uid <= {usd_x} THEN u.uid END AS ubid,
         CASE WHEN NOT (s.isBasePool AND 'T0' IN (s.t0, s.t1)) AND s.logId - u.uid <= {usd_x} THEN u.uaddr END AS ubaddr,
         CASE WHEN NOT (s.isBasePool AND 'T0' IN (s.t0, s.t1)) AND s.logId - u.uid <= {usd_x} THEN u.uv END AS ubv,
         CASE WHEN NOT (s.isBasePool AND 'T0' IN (s.t0, s.t1)) AND s.logId - u.uid <= {usd_x} THEN u.uis1 END AS ubis1
  FROM aq1 s ASOF LEFT JOIN uq u ON s.logId > u.uid),
cv AS (
  SELECT *,
         {cv0} AS cv0, {cv1} AS cv1, {cf0} AS cf0, {cf1} AS cf1
  FROM au),
ba AS (
  SELECT *,
         CASE WHEN t0 = 'ETH' THEN abs(N0) / 1e8 WHEN t1 = 'ETH' THEN abs(N1) / 1e8
              WHEN b0id >= b1id OR b1id IS NULL THEN cv0 WHEN b0id < b1id OR b0id IS NULL THEN cv1 END AS bvol,
         CASE WHEN t0 = 'ETH' THEN cv1 WHEN t1 = 'ETH' THEN cv0
              WHEN b0id >= b1id OR b1id IS NULL THEN cv1 WHEN b0id < b1id OR b0id IS NULL THEN cv0 END AS bvolbis,
         CASE WHEN t0 = 'ETH' THEN F0 / 1e8 + cf1 WHEN t1 = 'ETH' THEN cf0 + F1 / 1e8
              WHEN b0id >= b1id OR b1id IS NULL THEN cf0 + cf1 WHEN b0id < b1id OR b0id IS NULL THEN cf0 + cf1 END AS bfee,
         (gas * gp) / 1000.0 AS gasFees,
         CASE WHEN has_bf THEN (gp - 5) / 1000.0 END AS tip,
         CASE WHEN has_bf THEN 5 / 1000.0 END AS baseFee
  FROM cv),
ua AS (
  SELECT *, {u_vol} AS uvol, {u_volbis} AS uvolbis, {u_fee} AS ufee,
         {u_gas} AS ugas, {u_tip} AS utip, {u_bf} AS ubf
  FROM ba),
rated AS (
  SELECT *, ugas + ufee AS totalFeesUsd,
         gasFees + bfee AS totalFees,
         CASE WHEN bvol <> 0 THEN ((gasFees + bfee) / bvol) * 100 END AS totalFeePct
  FROM ua)
"""


def _conv(num: str, t: str) -> str:
    """convert(num / 1e8) by quote ``b{t}``: own price for a base pool with no quote."""
    return (f"CASE WHEN b{t}v IS NULL AND isBasePool THEN "
            f"(CASE WHEN is1 THEN CAST(({num}) * v AS DOUBLE) / 1e10 ELSE CAST({num} AS DOUBLE) / CAST(v * 1000000 AS DOUBLE) END) "
            f"WHEN b{t}is1 THEN CAST(({num}) * b{t}v AS DOUBLE) / 1e10 "
            f"ELSE CAST({num} AS DOUBLE) / CAST(b{t}v * 1000000 AS DOUBLE) END")


def _usd_of_double(x: str) -> str:
    """usd conversion of a double amount (the inverse of the base rule)."""
    return (f"CASE WHEN isBasePool AND 'T0' IN (t0, t1) THEN "
            f"(CASE WHEN is1 THEN ({x}) / (v / 100.0) ELSE ({x}) * (v / 100.0) END) "
            f"WHEN ubis1 THEN ({x}) / (ubv / 100.0) ELSE ({x}) * (ubv / 100.0) END")


def _usd_of_milli(num: str) -> str:
    """usd conversion of ``num / 1000`` with exact integer operands."""
    return (f"CASE WHEN isBasePool AND 'T0' IN (t0, t1) THEN "
            f"(CASE WHEN is1 THEN CAST(({num}) * 100 AS DOUBLE) / CAST(v * 1000 AS DOUBLE) "
            f"ELSE CAST(({num}) * v AS DOUBLE) / 100000.0 END) "
            f"WHEN ubis1 THEN CAST(({num}) * 100 AS DOUBLE) / CAST(ubv * 1000 AS DOUBLE) "
            f"ELSE CAST(({num}) * ubv AS DOUBLE) / 100000.0 END")


def swap_cte(delta_x: int = 20, base_x: int = 100, usd_x: int = 10) -> str:
    """The view's CTE chain with the expiries of the delta, the base quotes
    and the USD quote."""
    return SWAP_TEMPLATE.format(
        cv0=_conv("abs(N0)", "0"), cv1=_conv("abs(N1)", "1"), cf0=_conv("F0", "0"), cf1=_conv("F1", "1"),
        u_vol=_usd_of_double("bvol"),
        u_volbis=_usd_of_double("bvolbis"),
        u_fee=_usd_of_double("bfee"),
        u_gas=_usd_of_milli("gas * gp"),
        u_tip=f"CASE WHEN has_bf THEN {_usd_of_milli('gp - 5')} END",
        u_bf=f"CASE WHEN has_bf THEN {_usd_of_milli('5')} END",
        delta_x=delta_x, base_x=base_x, usd_x=usd_x)


SWAP_CTE = swap_cte()


def with_swaps(select: str, **expiries) -> str:
    return "WITH " + swap_cte(**expiries).strip() + "\n" + select.strip()


def rn(x: str, digits: int = 6) -> str:
    """Same quantization as ``catalog.r6`` (offset floor, no -0.0)."""
    return f"(floor(({x}) * 1e{digits} + 0.12345678) / 1e{digits} + 0.0)"


# pool-day groups of the rated view; prices kept as cents for exact deltas
DAY_CTE = """
, rg AS (
  SELECT *, 100.0 / v AS price0d, v / 100.0 AS price1d,
         (CAST(pv - v AS DOUBLE) / v) * 100 AS pct0, (CAST(v - pv AS DOUBLE) / pv) * 100 AS pct1,
         k - pk AS tickDelta, CASE WHEN has_bf THEN (gp - 5) / 1000.0 END AS resolvedTip
  FROM rated),
mu AS (
  SELECT date, address, pool, pair, avg(pct0) AS mu0, avg(pct1) AS mu1,
         min(pct0) = max(pct0) AS flat0, min(pct1) = max(pct1) AS flat1
  FROM rg GROUP BY date, address, pool, pair),
rgm AS (SELECT rg.*, mu.mu0, mu.mu1, mu.flat0, mu.flat1 FROM rg JOIN mu USING (date, address, pool, pair)),
day AS (
  SELECT date, address, pool, pair, count(*) AS swapCount,
         arg_min(v, logId) AS fv, arg_max(v, logId) AS lv, min(v) AS minv, max(v) AS maxv,
         min(logId) AS firstPriceLogId, max(logId) AS lastPriceLogId,
         sum(tickDepth0 * price0d) / nullif(sum(tickDepth0), 0) AS lwp0,
         sum(tickDepth1 * price1d) / nullif(sum(tickDepth1), 0) AS lwp1,
         sum(abs(pct0)) AS tt0, sum(abs(pct1)) AS tt1,
         count(pct0) AS n0, count(pct1) AS n1,
         avg(power(pct0 - mu0, 2)) AS m20, avg(power(pct0 - mu0, 3)) AS m30, avg(power(pct0 - mu0, 4)) AS m40,
         avg(power(pct1 - mu1, 2)) AS m21, avg(power(pct1 - mu1, 3)) AS m31, avg(power(pct1 - mu1, 4)) AS m41,
         bool_or(flat0) AS flat0, bool_or(flat1) AS flat1,
         CASE WHEN count(*) > 1 AND min(v) <> max(v) AND min(timestamp) <> max(timestamp)
              THEN covar_pop(price0d, timestamp) / (stddev_samp(price0d) * stddev_samp(timestamp)) END AS trend0,
         CASE WHEN count(*) > 1 AND min(v) <> max(v) AND min(timestamp) <> max(timestamp)
              THEN covar_pop(price1d, timestamp) / (stddev_samp(price1d) * stddev_samp(timestamp)) END AS trend1,
         sum(abs(N0)) AS sv0, sum(abs(N1)) AS sv1, sum(N0) AS sn0, sum(N1) AS sn1,
         sum(bvol) AS volumeBase, sum(uvol) AS volumeUsd, avg(bvol) AS avgVolumeBase, avg(uvol) AS avgVolumeUsd,
         quantile_cont(bvol, 0.5) AS medVolumeBase, quantile_cont(uvol, 0.5) AS medVolumeUsd,
         avg(abs(tickDelta)) AS avgTicks, quantile_cont(abs(tickDelta), 0.5) AS medTicks,
         avg(tickDepth0) AS avgTickDepth0, avg(tickDepth1) AS avgTickDepth1,
         avg(gas) AS avgGas, quantile_cont(gas, 0.5) AS medGas,
         quantile_cont(resolvedTip, 0.25) AS tipQ1, quantile_cont(resolvedTip, 0.5) AS tipQ2,
         quantile_cont(resolvedTip, 0.75) AS tipQ3,
         avg(totalFeePct) AS avgTotalFeePct, quantile_cont(totalFeePct, 0.5) AS medTotalFeePct,
         avg(totalFeesUsd) AS avgTotalFeesUsd, quantile_cont(totalFeesUsd, 0.5) AS medTotalFeesUsd
  FROM rgm GROUP BY date, address, pool, pair),
dd AS (
  SELECT *,
         100.0 / fv AS firstPrice0, fv / 100.0 AS firstPrice1, 100.0 / lv AS lastPrice0, lv / 100.0 AS lastPrice1,
         100.0 / maxv AS minPrice0, minv / 100.0 AS minPrice1, 100.0 / minv AS maxPrice0, maxv / 100.0 AS maxPrice1,
         CASE WHEN n0 > 0 AND NOT flat0 AND m20 > 0 THEN m30 / power(m20, 1.5) END AS skewness0,
         CASE WHEN n1 > 0 AND NOT flat1 AND m21 > 0 THEN m31 / power(m21, 1.5) END AS skewness1,
         CASE WHEN n0 > 0 AND NOT flat0 AND m20 > 0 THEN m40 / (m20 * m20) - 3 END AS kurtosis0,
         CASE WHEN n1 > 0 AND NOT flat1 AND m21 > 0 THEN m41 / (m21 * m21) - 3 END AS kurtosis1,
         sv0 / 1e8 AS volume0, sv1 / 1e8 AS volume1, sn0 / 1e8 AS netAmount0, sn1 / 1e8 AS netAmount1,
         CAST(100 * (fv - lv) AS DOUBLE) / CAST(lv * fv AS DOUBLE) AS priceDelta0,
         (lv - fv) / 100.0 AS priceDelta1,
         (CAST(fv - lv AS DOUBLE) / fv) * 100 AS priceDeltaPct0,
         (CAST(lv - fv AS DOUBLE) / lv) * 100 AS priceDeltaPct1,
         CAST(100 * (maxv - minv) AS DOUBLE) / CAST(minv * maxv AS DOUBLE) AS priceRange0,
         (maxv - minv) / 100.0 AS priceRange1,
         CASE WHEN maxv <> minv THEN (CAST((maxv - minv) * fv AS DOUBLE) / CAST(minv * maxv AS DOUBLE)) * 100 ELSE 0.0 END AS volatility0,
         CASE WHEN maxv <> minv THEN (CAST(maxv - minv AS DOUBLE) / fv) * 100 ELSE 0.0 END AS volatility1
  FROM day)
"""


def with_days(select: str) -> str:
    return "WITH " + SWAP_CTE.strip() + "\n" + DAY_CTE.strip() + "\n" + select.strip()
