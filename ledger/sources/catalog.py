"""Price-catalogue pages: paged JSON documents with a ``skus`` array.

The reference pulls pages from a REST endpoint on the driver and loops over SKUs in
Python.  Here the pages are files (or any frame of the same shape) read with an explicit
schema, so the extraction is a distributed ``explode`` + filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger.session import checkpoint_dir

UNIT_PRICE = T.StructType([T.StructField("units", T.StringType()), T.StructField("nanos", T.LongType())])
TIERED_RATE = T.StructType([T.StructField("unitPrice", UNIT_PRICE)])
PRICING_INFO = T.StructType(
    [
        T.StructField(
            "pricingExpression",
            T.StructType([T.StructField("tieredRates", T.ArrayType(TIERED_RATE))]),
        )
    ]
)
SKU = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField(
            "category",
            T.StructType([T.StructField("resourceFamily", T.StringType()), T.StructField("usageType", T.StringType())]),
        ),
        T.StructField("serviceRegions", T.ArrayType(T.StringType())),
        T.StructField("description", T.StringType()),
        T.StructField("pricingInfo", T.ArrayType(PRICING_INFO)),
    ]
)
PAGE_SCHEMA = T.StructType([T.StructField("skus", T.ArrayType(SKU)), T.StructField("nextPageToken", T.StringType()),
                            T.StructField("pageToken", T.StringType())])


class IncompleteCatalogError(ValueError):
    """The pages are no unbroken chain from a first to a last page."""


def read_catalog_pages(spark: SparkSession, path: str) -> DataFrame:
    """Read catalogue pages (one JSON document per file) with the declared schema."""
    return spark.read.schema(PAGE_SCHEMA).option("multiLine", "true").json(path)


def pages_from_flat(flat: DataFrame, page_size: int = 5000) -> DataFrame:
    """Nest flat SKU rows into page documents of at most ``page_size`` SKUs.

    Expected columns: name, resource_family, usage_type, regions_csv, description,
    units, nanos, has_tier.  A row whose ``has_tier`` is false gets an empty rate list.
    The page number is derived from the SKU number, so every page holds a bounded
    group (``page_size``) and pages build in parallel.
    """
    rate = F.struct(F.struct(F.col("units").alias("units"), F.col("nanos").alias("nanos")).alias("unitPrice"))
    rates = F.when(F.col("has_tier"), F.array(rate)).otherwise(F.array().cast(T.ArrayType(TIERED_RATE)))
    sku = F.struct(
        F.col("name").alias("name"),
        F.when(
            F.col("resource_family").isNotNull() | F.col("usage_type").isNotNull(),
            F.struct(F.col("resource_family").alias("resourceFamily"), F.col("usage_type").alias("usageType")),
        ).alias("category"),
        F.split(F.col("regions_csv"), ",").alias("serviceRegions"),
        F.col("description").alias("description"),
        F.array(F.struct(F.struct(rates.alias("tieredRates")).alias("pricingExpression"))).alias("pricingInfo"),
    ).cast(SKU)
    number = F.regexp_extract(F.col("name"), r"(\d+)$", 1).cast("long")
    return (
        flat.select(F.floor(number / page_size).alias("page"), sku.alias("sku"))
        .groupBy("page")
        .agg(F.collect_list("sku").alias("skus"))
        .select("skus", F.lit(None).cast("string").alias("nextPageToken"))
    )


FIRST = ""      # the token of the first page, and what the last page points to


def _links(pages: DataFrame) -> DataFrame:
    own = F.col("pageToken") if "pageToken" in pages.columns else F.lit(None).cast("string")
    return pages.select(F.coalesce(own, F.lit(FIRST)).alias("token"), F.coalesce("nextPageToken", F.lit(FIRST)).alias("next"))


def page_chain(pages: DataFrame) -> DataFrame:
    """``problem, token, pages``: what keeps the pages from being one chain; empty when whole.

    A page names the token it was asked for with (``pageToken``, none for the first page) and
    the token of the page after it (``nextPageToken``, none for the last one).

    * ``repeated``     several pages answer one token (the first page's token is empty);
    * ``missing``      a page points to a token that no page answers, or there is no first page;
    * ``no end``       no page is the last one;
    * ``not reached``  a page that the chain from the first page does not come to, be it that
      others point to it in a ring or that the page before it is not there.

    The chain is followed by pointer doubling: after k rounds every token knows the one 2^k
    pages on, and the pages within 2^k of the first are known, so a chain of n pages takes
    log2(n) joins, not n.  Each round is cut off by a checkpoint in the shared folder.  Only
    one count a round reaches the driver.  No pages at all lack the first one.
    """
    spark = pages.sparkSession
    checkpoint_dir(spark)
    links = _links(pages).checkpoint()
    counted = links.groupBy("token").agg(F.count(F.lit(1)).alias("pages"))
    onward = links.where(F.col("next") != FIRST)
    first = spark.range(1).select(F.lit(FIRST).alias("token"))
    wanted = onward.select(F.col("next").alias("token")).unionAll(first).distinct()
    jump = onward.distinct()
    reached = first.join(counted, "token", "left_semi").checkpoint()
    size = reached.count()
    while size:
        on = reached.join(jump, "token").select(F.col("next").alias("token"))
        reached = reached.unionAll(on).distinct().checkpoint()
        grown = reached.count()
        if grown == size:
            break
        size = grown
        far = jump.select(F.col("next").alias("token"), F.col("token").alias("from"))
        jump = far.join(jump, "token").select(F.col("from").alias("token"), "next").distinct().checkpoint()
    found = lambda problem, rows: rows.select(F.lit(problem).alias("problem"), "token", "pages")
    none = F.lit(0).cast("long").alias("pages")
    ends = links.agg(F.count_if(F.col("next") == FIRST).alias("ends"), F.count(F.lit(1)).alias("n")).where("ends = 0 AND n > 0")
    return (
        found("repeated", counted.where(F.col("pages") > 1))
        .unionAll(found("missing", wanted.join(counted, "token", "left_anti").withColumn("pages", none)))
        .unionAll(found("no end", ends.select(F.lit(FIRST).alias("token"), none)))
        .unionAll(found("not reached", counted.join(reached, "token", "left_anti")))
    )


def require_whole_catalog(pages: DataFrame) -> None:
    """Raise ``IncompleteCatalogError`` with the first problems where ``page_chain`` has any."""
    found = page_chain(pages).orderBy("problem", "token").limit(10).collect()
    if found:
        raise IncompleteCatalogError("; ".join(f"{r.problem}: page '{r.token}' ({r.pages} pages)" for r in found))
