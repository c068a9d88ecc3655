"""Submission catalogue and download manifest (SRC10, SRC13, SRC14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- FIXED VALUES: supported compression suffixes -------------------------------
COMPRESSIONS = ("xz", "gz", "zip")


def list_submissions(spark: SparkSession, path: str, domains=(), service: str | None = None,
                     lang: str = "en", multi_line: bool = True) -> DataFrame:
    """SRC10/SRC14: submissions whose domain is in ``domains`` (case-insensitive;
    empty = all), with the TMX URL ``service/lang/submissions/<id>.tmx``.

    ``multi_line=True`` reads one JSON document per file (the API answer);
    ``False`` reads JSON lines, which split across tasks.
    """
    doc = spark.read.option("multiLine", str(multi_line).lower()).json(path)
    subs = doc.select(F.explode("submissions").alias("s")).select("s.*")
    wanted = [d.lower() for d in domains]
    if wanted:
        subs = subs.where(F.lower(F.col("domain")).isin(*wanted))
    url = F.concat_ws("/", F.lit(service), F.lit(lang), F.lit("submissions"),
                      F.concat(F.col("id").cast("string"), F.lit(".tmx")))
    return subs.withColumn("url", url)


def download_manifest(urls: DataFrame, data_dir: str, col: str = "url") -> DataFrame:
    """SRC13: ``url, storage_path, compression_type`` per URL.

    Storage name = URL path parts joined by ``_``; a known compression
    suffix is cut from the name and reported as the compression type.
    """
    path = F.parse_url(F.col(col), F.lit("PATH"))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    name = F.array_join(parts, "_")
    comp = F.regexp_extract(path, r"\.(" + "|".join(COMPRESSIONS) + r")$", 1)
    stem = F.when(comp != "", F.regexp_replace(name, r"\.[^.]+$", "")).otherwise(name)
    return urls.select(F.col(col).alias("url"),
                       F.concat(F.lit(data_dir.rstrip("/") + "/"), stem).alias("storage_path"),
                       F.when(comp != "", comp).alias("compression_type"))
