"""Default report parameters used by the registered queries and the bench.

The range covers every event of the test data (2024-01-01 .. 2024-01-30),
so each report runs over its whole tables.
"""

FROM_TS = "2024-01-01 00:00:00"
TO_TS = "2024-01-31 00:00:00"
# a range starting inside the data, so "latest Register before from_date"
# fallbacks and sessions cut at the range start are exercised
MID_FROM_TS = "2024-01-10 00:00:00"
MID_TO_TS = "2024-01-20 12:00:00"
COMPANY = 1
TENANT = 1
SKILLS = "skill0,skill1,skill2"
B_UNIT = "BU2"  # a unit of tenant 1 in the derived tables
AGENT = "6"  # an agent of tenant 1, company 1 in the derived tables
FROM_HOUR = 8
TO_HOUR = 18
TZ = "Asia/Colombo"
# fixed offset of TZ in the test period (no daylight saving), used by the oracle
TZ_OFFSET_MINUTES = 330
