"""Track-shaped bronze rows derived from the driver tables.

The driver tables hold no music data, so bronze tracks are derived from
`lineitem JOIN part`: one line item is one raw track record, parts are tracks
(so each track id has many raw copies to deduplicate), suppliers are artists.
The SAME SQL text runs in Spark and in the DuckDB oracle, so both engines see
identical inputs.  Every derived column is a fixed arithmetic rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moodlake.sources.tables import read_table

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Genre per l_partkey % 14; 13 -> null genre.  "polka" is deliberately absent
# from the family map (falls back to the default family).
_GENRES = ["pop", "k-pop", "hip-hop", "house", "techno", "rock", "jazz", "ambient", "salsa",
           "metal", "folk", "funk", "polka"]


def _u(a: int, b: int, c: int, m: int) -> str:
    return (f"cast((l.l_orderkey * {a} + l.l_partkey * {b} + l.l_linenumber * {c}) % {m} as double)"
            f" / cast(1000 as double)")


def _genre_case() -> str:
    whens = " ".join(f"when {i} then '{g}'" for i, g in enumerate(_GENRES))
    return f"case l.l_partkey % 14 {whens} else null end"


BRONZE_SQL_TEMPLATE = f"""
select
  concat('T', cast(l.l_partkey as string)) as track_id,
  p.p_name as track_name,
  concat('Artist ', cast(l.l_suppkey as string),
         case when l.l_linenumber % 3 = 0
              then concat(' ; Artist ', cast(l.l_orderkey % 50 as string)) else '' end) as artists,
  p.p_brand as album_name,
  {_genre_case()} as track_genre,
  cast(floor(l.l_quantity) as bigint) as popularity,
  cast(floor(l.l_extendedprice) as bigint) as duration_ms,
  l.l_returnflag = 'R' as explicit,
  {_u(7, 13, 17, 1010)} as danceability,
  {_u(11, 3, 29, 1005)} as energy,
  {_u(5, 19, 23, 1005)} as valence,
  {_u(17, 7, 3, 1005)} as acousticness,
  {_u(3, 31, 7, 1005)} as instrumentalness,
  {_u(23, 11, 5, 1005)} as speechiness,
  {_u(13, 5, 11, 1005)} as liveness,
  case when (l.l_orderkey + l.l_partkey) % 97 = 0 then null
       else cast(50 + (l.l_orderkey * 3 + l.l_partkey * 7) % 150 as double) end as tempo,
  -cast((l.l_orderkey * 7 + l.l_linenumber) % 60 as double) as loudness,
  cast(l.l_orderkey % 12 as bigint) as key,
  cast((l.l_partkey + l.l_linenumber) % 2 as bigint) as mode,
  cast(3 + l.l_linenumber % 3 as bigint) as time_signature,
  l.l_shipdate as ingestion_timestamp,
  'kaggle' as source,
  l.l_orderkey as src_orderkey,
  l.l_linenumber as src_linenumber,
  l.l_suppkey as src_suppkey
from {{lineitem}} l
join {{part}} p on l.l_partkey = p.p_partkey
"""
# Table names for a SQL engine with the tables registered by name.
BRONZE_SQL = BRONZE_SQL_TEMPLATE.format(lineitem="lineitem", part="part")

# Total order for latest-wins dedup of the fixture rows.
BRONZE_TIEBREAK = ["src_orderkey", "src_linenumber", "src_suppkey", "popularity", "duration_ms"]

# Cut-offs and run times of three successive artist snapshots (SCD2 tests).
SNAPSHOTS = [("2001-03-01", "2024-01-01 00:00:00"),
             ("2001-11-01", "2024-02-01 00:00:00"),
             (None, "2024-03-01 00:00:00")]
RUN_TS = "2024-03-01 00:00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", "parquet")


def bronze_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw track records (bronze) derived from lineitem x part."""
    # DataFrames bound as SQL parameters: no temp views left in the session
    return spark.sql(BRONZE_SQL_TEMPLATE, lineitem=read(spark, sf_dir, "lineitem"), part=read(spark, sf_dir, "part"))


def bronze_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id and time of every line item.  The join that makes bronze is on the id
    itself and keeps all line items of an id or none, so the latest time of each
    id in bronze is the latest one here."""
    return read(spark, sf_dir, "lineitem").selectExpr("concat('T', cast(l_partkey as string)) as track_id",
                                                      "l_shipdate as ingestion_timestamp")


def albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New-release album records derived from the driver tables: an order is
    an album, its line items are tracks, the supplier (plus a second artist on
    every third line) are the track's artists.  Orders without line items are
    albums with an empty track list."""
    from pyspark.sql import functions as F

    o = read(spark, sf_dir, "orders").select("o_orderkey")
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                "l_extendedprice", "l_returnflag")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    t = li.join(p, li["l_partkey"] == p["p_partkey"], "left").join(s, li["l_suppkey"] == s["s_suppkey"], "left")
    second = F.struct(F.concat(F.lit("Artist "), (F.col("l_orderkey") % 50).cast("string")).alias("name"))
    artists = F.when(F.col("l_linenumber") % 3 == 0,
                     F.array(F.struct(F.col("s_name").alias("name")), second)
                     ).otherwise(F.array(F.struct(F.col("s_name").alias("name"))))
    track = F.struct(
        F.concat(F.lit("T"), F.col("l_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("name"),
        artists.alias("artists"),
        F.floor("l_extendedprice").cast("bigint").alias("duration_ms"),
        (F.col("l_returnflag") == "R").alias("explicit"),
    )
    # one record per page of up to 50 line numbers (the feed pages album
    # tracks too), so no record grows with the size of one order
    per_page = t.groupBy("l_orderkey", F.floor(F.col("l_linenumber") / 50).alias("_page")).agg(
        F.collect_list(track).alias("tracks"))
    a = o.join(per_page, o["o_orderkey"] == per_page["l_orderkey"], "left")
    return a.select(F.concat(F.lit("A"), F.col("o_orderkey").cast("string")).alias("id"),
                    F.concat(F.lit("Album "), F.col("o_orderkey").cast("string")).alias("name"),
                    "tracks")
