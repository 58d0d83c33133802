"""Code lists in SDMX structure files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

_SCHEMA = "_id string, Code array<struct<_id: string, Name: array<struct<_lang: string, _VALUE: string>>>>"


def read_codelists(spark: SparkSession, path: str, language: str = "en") -> DataFrame:
    """One row per code: ``codelist, position, code, label``.

    The label is the one in ``language``, else the first one. Codes without a
    label are left out, and positions count from 0 over those that remain.
    """
    lists = (
        spark.read.format("xml").schema(_SCHEMA)
        .option("rowTag", "Codelist").option("ignoreNamespace", True)
        .load(path)
    )

    def labelled(code):
        names = code["Name"]
        preferred = F.filter(names, lambda name: name["_lang"] == language)
        chosen = F.coalesce(F.get(preferred, F.lit(0)), F.get(names, F.lit(0)))
        return F.struct(code["_id"].alias("code"), F.trim(chosen["_VALUE"]).alias("label"))

    usable = F.filter(
        F.transform("Code", labelled),
        lambda entry: (entry["code"] != "") & (entry["label"] != ""),
    )
    return (
        lists.select(F.col("_id").alias("codelist"), F.posexplode(usable).alias("position", "entry"))
        .groupBy("codelist", F.col("entry.code").alias("code"))
        # A code listed twice keeps its first place and its last label.
        .agg(
            F.min("position").alias("position"),
            F.max_by("entry.label", "position").alias("label"),
        )
        # Places close up over repeated codes; a list is bounded, it was one element
        .withColumn("position", F.row_number().over(Window.partitionBy("codelist").orderBy("position")) - 1)
        .select("codelist", "position", "code", "label")
    )


def labels_of(codelists: DataFrame, codelist: str, code: str, label: str) -> DataFrame:
    """The labels of one list, renamed so that they join on ``code``."""
    return codelists.filter(F.col("codelist") == codelist).select(
        *[c for c in codelists.columns if c not in ("codelist", "position", "code", "label")],
        F.col("code").alias(code),
        F.col("label").alias(label),
    )
