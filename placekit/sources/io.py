"""Readers and sinks: place CSV files, published tables, publish manifests."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from placekit.functions.text import utrim
from placekit.operators.changes import content_fingerprint
from placekit.session import materialize
from placekit.sources.publish import commit_snapshot, job_lock, newest

# The place CSV header, in order (the exchange format of the
# place files both feeds are compared and exported with).
PLACE_CSV_COLUMNS = [
    "deeplink", "plusCode", "addDate", "updateDate", "paymentMethod", "merchantId", "id", "active",
    "name", "address1", "address2", "address3", "address4", "latitude", "longitude", "website",
    "phone", "territory", "city", "source", "sourceId", "logoLocation", "googleMaps", "coverImage",
    "type", "redeemType", "savingsPercentage", "denominationsType", "instagram", "twitter",
    "delivery", "monOpen", "monClose", "tueOpen", "tueClose", "wedOpen", "wedClose", "thuOpen",
    "thuClose", "friOpen", "friClose", "satOpen", "satClose", "sunOpen", "sunClose"]
_TYPED = {"id": "int", "active": "boolean", "latitude": "double", "longitude": "double",
          "savingsPercentage": "int"}
PUBLISH_COERCIONS = {"merchantId": "", "sourceId": "", "active": False, "latitude": 0.0,
                     "longitude": 0.0, "redeemType": "none", "savingsPercentage": 0}


def to_place_csv_columns(df: DataFrame) -> DataFrame:
    """Project any place table onto the 45 CSV columns (missing ones null)."""
    cols = []
    for c in PLACE_CSV_COLUMNS:
        t = _TYPED.get(c, "string")
        cols.append((F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c))
    return df.select(*cols)


def csv_export(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write places as CSV: 45 columns in order, header, null -> empty field,
    fields quoted only when they hold a comma, quote or line break."""
    (to_place_csv_columns(df).write.mode(mode)
        .option("header", True).option("quote", '"').option("escape", '"')
        .option("nullValue", "").option("emptyValue", "").option("quoteAll", False)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path))


_RECORD = "_record"  # text of a row whose number of fields differs from the header's


def _csv_rows(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    schema = StructType([StructField(c, StringType()) for c in [*PLACE_CSV_COLUMNS, _RECORD]])
    return (spark.read.schema(schema)
            .option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _RECORD).option("columnPruning", False)
            .option("enforceSchema", True).csv(path))


def _short_row():
    """Fewer fields than the header: commas outside quotes, plus one."""
    bare = F.regexp_replace(F.col(_RECORD), '"(?:[^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    # reads a data column too: Spark refuses queries on the record's text alone
    data = F.length(F.concat_ws("", F.col(PLACE_CSV_COLUMNS[0]))) >= 0
    return F.coalesce(data & (fields < len(PLACE_CSV_COLUMNS)), F.lit(False))


def csv_short_rows(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The text of the rows that ``csv_place_scan`` leaves out."""
    return _csv_rows(spark, path, multi_line).filter(_short_row()).select("name", F.col(_RECORD).alias("record"))


def csv_place_scan(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Read place CSV files: values trimmed, empty -> null, lenient typed
    parsing (bad values -> null).  Rows with more fields than the header keep
    the first ones; rows with fewer are left out (``csv_short_rows`` has them).

    ``multi_line`` reads values with line breaks; without it a large file is
    split between tasks.
    """
    raw = _csv_rows(spark, path, multi_line).filter(~_short_row())
    cols = []
    for c in PLACE_CSV_COLUMNS:
        v = utrim(F.col(c))
        v = F.when(v == "", F.lit(None).cast("string")).otherwise(v)
        t = _TYPED.get(c)
        if t == "boolean":
            v = F.when(v == "true", F.lit(True)).when(v == "false", F.lit(False))
        elif t:
            v = v.try_cast(t)
        cols.append(v.alias(c))
    return raw.select(*cols)


def nonempty_guard(df: DataFrame, table: str) -> DataFrame:
    """A table load with zero rows is an error."""
    if df.isEmpty():
        raise ValueError(f"no data received for table {table}")
    return df


def coerce_for_publish(df: DataFrame) -> DataFrame:
    """Publish coercions: null merchant/source ids -> '', active -> false,
    coordinates -> 0.0, redeem type -> 'none', savings -> 0."""
    out = df
    for c, v in PUBLISH_COERCIONS.items():
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def explore_table(feed_c: DataFrame, combined: DataFrame) -> DataFrame:
    """Curated rows followed by combined rows, with publish coercions."""
    cols = [c for c in PLACE_CSV_COLUMNS if c != "id"]
    a = to_place_csv_columns(feed_c).select(*cols).withColumn("part", F.lit(0))
    b = to_place_csv_columns(combined).select(*cols).withColumn("part", F.lit(1))
    return coerce_for_publish(a.unionByName(b))


def snapshot_scan(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """Previous archive rows (optionally one source; partition pruning when the
    archive is partitioned by ``source``)."""
    df = spark.read.parquet(path)
    return df if source is None else df.filter(F.col("source") == source)


def publish_tables(tables: dict, root: str, mode_name: str, snapshot_date: str) -> None:
    """Write each table as parquet under ``root/<table>``, partitioned by
    ``mode`` and ``snapshot_date``; reruns replace only their own partition."""
    for name, df in tables.items():
        (df.withColumn("mode", F.lit(mode_name)).withColumn("snapshot_date", F.lit(snapshot_date))
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("mode", "snapshot_date").parquet(f"{root.rstrip('/')}/{name}"))


def publish_if_changed(tables: dict, root: str, mode_name: str, snapshot_date: str,
                       force: bool = False) -> bool:
    """Publish only when the content fingerprint differs from the last
    published one for ``mode_name`` (or when ``force``).  Returns whether it wrote.

    One job at a time holds the lock of the mode (``publish.job_lock``), and readers
    of ``publish.published`` see the old set of tables or the new one, never a mixture.
    What is published is first written to the shared folder, so its plan runs
    once for fingerprint, comparison and publish.
    """
    spark = next(iter(tables.values())).sparkSession
    with job_lock(spark, root, mode_name):
        tables = {name: materialize(df) for name, df in tables.items()}
        fps = None
        for name, df in tables.items():
            fp = content_fingerprint(df, "xxhash64").select(F.lit(name).alias("table"), "*")
            fps = fp if fps is None else fps.unionByName(fp)
        fps = fps.withColumn("hash_sum", F.col("hash_sum").cast("string"))
        current = {r["table"]: (r["row_count"], r["hash_xor"], r["hash_sum"]) for r in fps.collect()}
        previous = {r["table"]: (r["row_count"], r["hash_xor"], r["hash_sum"]) for r in newest(spark, root, mode_name)}
        if not force and previous == current:
            return False
        commit_snapshot(tables, root, mode_name, snapshot_date, current)
    return True


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``; None if nothing is there yet.  Any other
    failure to read is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


# ---------------------------------------------------------------- landed JSON feeds

_HOURS = ", ".join(f"{d}{oc} string" for d in ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                                              "Saturday", "Sunday") for oc in ("Open", "Close"))
# Schemas (DDL) of the landed raw feeds, field names as the feeds deliver them.
FEED_SCHEMAS = {
    "brands_a": ("seq bigint, id string, name string, enabled boolean, type string, deeplink string, "
                        "website string, logoUrl string, cardImageUrl string, redeemType string, "
                        "savingsPercentage int, denominationsType string"),
    "locations_a": ("seq bigint, id string, merchantId string, address1 string, address2 string, "
                           "postalCode string, phone string, territory string, city string, sourceId string, "
                           f"latitude double, longitude double, {_HOURS}"),
    "brands_b": ("seq bigint, id string, name string"),
    "offers_b": ("seq bigint, id int, name string, description string, image string, price_type string, "
                        "currency string, discount_percentage double, min_denomination double, "
                        "max_denomination double, denomination string, fee int, quantity int, brand_id string"),
    "locations_b": ("seq bigint, name string, brand_id string, latitude double, longitude double, "
                           "street_number string, street string, city string, state string, zip string, "
                           "country string, opening_hours string, phone string, shop string, website string, "
                           "wheelchair string"),
    "kiosks": ("id int, url string, image_url string, type string, operator string, operator_logo string, "
                      "operator_phone string, location string, country string, state string, city string, "
                      "address string, is_247 int, open_hours string, lat double, lng double, buy int, sell int, "
                      "updated_online bigint, buy_fee_perc string, sell_fee_perc string, fiat string, "
                      "buy_fee_amt string, sell_fee_amt string"),
}


def _sheet_schema() -> str:
    from placekit.sources.fixtures import SHEET_COLUMNS
    return "row_key string, seq bigint, " + ", ".join(f"{c} string" for c in SHEET_COLUMNS)


FEED_SCHEMAS["sheet_c"] = _sheet_schema()


def read_sheet_csv(spark: SparkSession, path: str) -> DataFrame:
    """The curated sheet as exported: columns by position, the header row
    skipped whatever it says, missing cells null.  ``row_key`` is the hash of
    the row's cells."""
    from placekit.sources.fixtures import SHEET_COLUMNS
    schema = StructType([StructField(c, StringType()) for c in SHEET_COLUMNS])
    rows = (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
                 .option("quote", '"').option("escape", '"').option("multiLine", True)
                 .option("mode", "PERMISSIVE").csv(path))
    return rows.select(F.sha2(F.to_json(F.struct(*SHEET_COLUMNS)), 256).alias("row_key"), *SHEET_COLUMNS)


def register_views(tables: dict, prefix: str = "") -> None:
    """Archive and published tables as SQL temp views, for ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def read_feed_json(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """Read landed JSON feed records with an explicit schema.

    Missing or null fields are null.  A value of the wrong JSON type fails the
    read when ``strict`` (``FAILFAST``); otherwise the record is kept with
    null fields and its text in ``_corrupt_record`` for quarantine.
    """
    reader = spark.read.option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if strict:
        return reader.schema(schema).json(path)
    return (reader.schema(f"{schema}, _corrupt_record string")
                  .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
