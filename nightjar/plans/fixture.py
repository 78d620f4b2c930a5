"""Run parameters of the checked queries (dates of the trial in FIXTURES.md)."""

import datetime as dt

AS_OF = dt.date(2024, 1, 31)          # report day; telemetry ends 2024-01-30
PREV_AS_OF = dt.date(2024, 1, 30)     # previous run (state and report)
DELTA_AS_OF = dt.date(2024, 1, 15)    # report that report_delta compares with
DELTA_MASTER_STEP = 9                 # its master lacks every 9th vehicle
LOOKBACK = 60                         # first run: as_of and 60 days back
INCREMENTAL_LOOKBACK = 1              # later runs: as_of and the day before
RETENTION_TRIAL_DAYS = 10             # retention exercised: 30 days never reach 60
WINDOW_TRIAL_AS_OF = dt.date(2024, 2, 2)   # partition window across a month end
WINDOW_TRIAL_LOOKBACK = 6
CARRY_RUNS = (dt.date(2024, 1, 15), dt.date(2024, 1, 16), AS_OF)   # sessions go on over two midnights
BATCH_SEQ = (AS_OF - dt.date(1970, 1, 1)).days * 4_294_967_296   # ingest sequence of this run's rows
DUPLICATE_SEQ_OFFSET = 1_000_000      # second master copy, ingested later
STATE_BUCKETS = 8                     # files a run in the bucketed state logs
CLUSTER_RUNS = (dt.date(2024, 1, 27), dt.date(2024, 1, 29), AS_OF)   # places come and go twice, over gaps of two days
