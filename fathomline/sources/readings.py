"""Published rows as keyed readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions.identity import key
from fathomline.functions.scalars import month_of, parse_stamp, safe_double
from fathomline.functions.schema import struct

KEYED = "file string, unique_id string, provider string, lon string, lat string, depth string, time string, key string, coll_month string, ingested timestamp, lon_d double, lat_d double"


def keyed(rows: DataFrame) -> DataFrame:
    """Identity, month and ingest stamp of published rows that carry their `file`. Text stays as published."""
    c = F.col
    text = rows.select("file", *(c(n).alias(n.lower()) for n in ("UNIQUE_ID", "PROVIDER", "LON", "LAT", "DEPTH", "TIME")))
    made = text.withColumns({
        "key": key(c("lon"), c("lat"), c("depth"), c("time")), "coll_month": month_of(F.coalesce("time", F.lit(""))), "ingested": parse_stamp(c("file")),
        "lon_d": safe_double(c("lon")), "lat_d": safe_double(c("lat")),
    })
    return made.select(*struct(KEYED).names)
