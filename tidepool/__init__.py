"""tidepool: a PySpark engine for decentralised-exchange swap analytics."""
