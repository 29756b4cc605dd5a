"""ISO-8601 text -> epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_epoch(ts: Column) -> Column:
    """Epoch seconds, or null when empty / malformed; 'Z' and offsets honoured.

    Read are the extended form (2024-01-15, 2024-01-15T12:00:00+09:00), the basic
    form (20240115, 20240115T120000, 20240115T120000Z) and week dates (2024-W03-1,
    2024W031). Anything else is null: a plain cast would read '12:00' as today and
    take zone names. Naive inputs are read in the session time zone (UTC).
    """
    zone = r"(Z|[+-]\d{2}(:?\d{2})?)?"
    year, week = F.substring(ts, 1, 4).cast("int"), F.regexp_extract(ts, r"W(\d{2})", 1).try_cast("int")
    day = F.coalesce(F.regexp_extract(ts, r"W\d{2}-?(\d)$", 1).try_cast("int"), F.lit(1))
    # week 1 holds January 4th
    first = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_sub(first, F.weekday(first))
    of_week = F.when((week >= 1) & (week <= 53) & (day >= 1) & (day <= 7), F.date_add(monday, (week - 1) * 7 + day - 1).cast("timestamp"))
    parsed = (F.when(ts.rlike(rf"^\d{{4}}-\d{{2}}-\d{{2}}([T ]\d{{2}}:\d{{2}}(:\d{{2}}([.]\d+)?)?{zone})?$"), F.try_to_timestamp(ts))
               .when(ts.rlike(r"^\d{8}T\d{6}(Z|[+-]\d{2}:?\d{2})$"), F.coalesce(F.try_to_timestamp(ts, F.lit("yyyyMMdd'T'HHmmssX")), F.try_to_timestamp(ts, F.lit("yyyyMMdd'T'HHmmssXXX"))))
               .when(ts.rlike(r"^\d{8}T\d{6}$"), F.try_to_timestamp(ts, F.lit("yyyyMMdd'T'HHmmss")))
               .when(ts.rlike(r"^\d{8}$"), F.try_to_timestamp(ts, F.lit("yyyyMMdd")))
               .when(ts.rlike(r"^\d{4}(-W\d{2}(-\d)?|W\d{2}\d?)$"), of_week))
    return F.unix_timestamp(parsed)
