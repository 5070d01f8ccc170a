"""Parameters of the registered queries (fixed so runs are repeatable).

The fixture events span 2024-01-01 .. 2024-01-30. ``AS_OF`` replaces the
wall clock; the driver-facing fraud queries use a lower velocity threshold and
a wider rapid-transfer window than the defaults so that they return rows at
small scale (the defaults are exercised by unit tests).
"""

AS_OF = "2024-01-31"
DAY = "2024-01-15"
LAST_N_DAYS = 7
LAST_DAYS_FROM = "2024-01-24"  # AS_OF less LAST_N_DAYS
VELOCITY_THRESHOLD = 5
RAPID_MINUTES = 120
SPIKE_FACTOR = 5.0
OFF_HOURS_AMOUNT = 100_000
SECRET = "dev-secret-change-in-production"
RETENTION_AS_OF = "2025-01-14"
RETENTION_DAYS = 365
LANDED_UNTIL = "2024-01-21"  # incremental load: days before this are already landed
SLICE_START = "2024-01-05"
SLICE_END = "2024-01-20"
PAGE_SIZE = 1000
