"""Landed wiki responses -> space documents and content batches.

Landing format: JSON lines, one per response, with ``source_dir``, ``start``
(listing offset; absent for the space document), ``status`` (HTTP status)
and ``body`` (response text; null when it could not be decoded).  Page fields are typed strictly: a title or
body that is not a JSON string counts as missing (``untitled`` / empty),
as does an ancestor title that is not a string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas


# Fixed value: the space document text when the response body could not be decoded.
UNDECODABLE_BODY = "<Failed to decode response body>"
# Fixed value: texts below this size always fit a variant.
VARIANT_BYTES = 16 * 1024 * 1024


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LANDED_RESPONSES).json(path)


def _string_at(v: Column, path: str) -> Column:
    """The value at ``path`` if it is a JSON string, else NULL."""
    node = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(node) == "STRING", F.try_variant_get(v, path, "string"))


def _page(r: Column) -> Column:
    ancestors = F.try_variant_get(r, "$.ancestors", "array<variant>")
    return F.struct(
        _string_at(r, "$.title").alias("title"),
        F.struct(F.struct(_string_at(r, "$.body.storage.value").alias("value")).alias("storage")).alias("body"),
        F.transform(ancestors, lambda a: F.struct(_string_at(a, "$.title").alias("title"))).alias("ancestors"),
    )


def content_batches(responses: DataFrame) -> DataFrame:
    """Listing responses -> ``schemas.CONTENT_BATCHES``.

    ``parsed`` is false when the body is not JSON (a listing past the size
    of a variant is judged by its typed reading); ``results`` missing or not
    an array gives an empty batch (not a failed one).
    """
    listing = responses.where(F.col("start").isNotNull())
    strict = {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    typed = F.from_json(F.col("body"), "struct<results: array<variant>, _bad: string>", strict)
    results = typed["results"]
    long = F.octet_length("body") >= VARIANT_BYTES
    parsed = F.try_parse_json(F.col("body")).isNotNull() | F.coalesce(long & typed["_bad"].isNull(), F.lit(False))
    return listing.select(
        "source_dir",
        "start",
        "status",
        parsed.alias("parsed"),
        F.transform(F.coalesce(results, F.array().cast("array<variant>")), _page).alias("results"),
    )


def space_documents(responses: DataFrame) -> DataFrame:
    """Space responses (no ``start``) -> (source_dir, status, body).

    A body the landing could not decode is landed as null and stored as a
    fixed text (S4).
    """
    return responses.where(F.col("start").isNull()).select(
        "source_dir", "status", F.coalesce(F.col("body"), F.lit(UNDECODABLE_BODY)).alias("body")
    )


class SpaceFetchError(RuntimeError):
    pass


def failed_spaces(spaces: DataFrame) -> DataFrame:
    """Space documents with a non-2xx status, or with none."""
    return spaces.where(~F.coalesce(F.col("status").between(200, 299), F.lit(False)))


def check_spaces(spaces: DataFrame) -> None:
    """A space document that failed fails the run, showing its body."""
    bad = failed_spaces(spaces).limit(1).collect()
    if bad:
        r = bad[0]
        raise SpaceFetchError(f"space {r['source_dir']} returned status {r['status']}: {r['body']}")
