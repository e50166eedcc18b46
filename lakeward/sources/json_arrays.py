"""Yearly JSON answers: an array of flat text maps whose first element holds the labels.

One answer is one file. The web interface that issues them limits the values
per answer, so a file fits one task; years are what spreads over tasks.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.text import normalize_label, regex_group
from lakeward.sources.files import path_list

ANSWER_TYPE = "array<map<string,string>>"
# Fixed value: where the year stands in a file name.
YEAR_PATTERN = r"_([0-9]{4})\.json$"


def scan_answers(
    spark: SparkSession, paths: str | Iterable[str], year_pattern: str = YEAR_PATTERN
) -> DataFrame:
    """One row per file: its path, year (from the path) and parsed array, or the error for which it is set aside."""
    text = spark.read.option("wholetext", True).text(path_list(paths))
    found = text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("bytes"),
        regex_group(F.col("_metadata.file_path"), year_pattern).cast("int").alias("ANO"),
        F.from_json("value", ANSWER_TYPE).alias("answer"),
    )
    labels = F.try_element_at("answer", F.lit(1))
    error = (
        F.when(F.col("ANO").isNull(), "no year in the name")
        .when(F.col("answer").isNull(), "not an array of JSON objects")
        .when(labels.isNull() | (F.size(labels) == 0), "no element with labels")
    )
    return found.withColumn("error", error)


def read_well(answers: DataFrame) -> DataFrame:
    return answers.where("error is null")


def set_aside(answers: DataFrame) -> DataFrame:
    """(path, name, bytes, error) of the answers that tell nothing about their year."""
    name = F.element_at(F.split("path", "/"), -1)
    return answers.where("error is not null").select("path", name.alias("name"), "bytes", "error")


def _data_elements(answers: DataFrame, *keep: str) -> DataFrame:
    """One row per array element after the label element."""
    data = F.slice(F.col("answer"), F.lit(2), F.greatest(F.size("answer") - 1, F.lit(0)))
    return answers.select("ANO", *keep, F.explode(data).alias("row"))


def _last_code(name: str) -> Column:
    """The last of the parallel arrays codes and names whose name is `name`."""
    pairs = F.arrays_zip("codes", "names")
    return F.try_element_at(F.filter(pairs, lambda pair: pair["names"] == name), F.lit(-1))["codes"]


def labelled_rows(answers: DataFrame) -> DataFrame:
    """Columns named after the normalised labels of the file's own first element.

    Where two codes share a label the later one counts. Files may use different
    codes for one label; columns are united by label.
    """
    labels = F.element_at("answer", 1)
    named = answers.select(
        "ANO",
        "answer",
        F.map_keys(labels).alias("codes"),
        F.transform(F.map_values(labels), normalize_label).alias("names"),
    )
    # Labels of all files, without copies: as many rows as the table has columns.
    columns = [
        row["name"]
        for row in named.select(F.explode("names").alias("name")).distinct().orderBy("name").collect()
    ]
    coded = named.withColumn(
        "code_of", F.struct(*[_last_code(name).alias(f"c{i}") for i, name in enumerate(columns)])
    )
    rows = _data_elements(coded, "code_of")
    return rows.select(
        *[
            F.try_element_at("row", F.col(f"code_of.c{i}")).alias(name)
            for i, name in enumerate(columns)
        ],
        "ANO",
    )


def picked_rows(answers: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Chosen codes under given names; a code missing from an element is null."""
    rows = _data_elements(answers)
    picked = [F.try_element_at("row", F.lit(code)).alias(name) for name, code in columns.items()]
    return rows.select(*picked, "ANO")


# Codes and column names of the population answers.
POPULATION_COLUMNS = {
    "COD_MUNICIPIO": "D1C",
    "NOME_MUNICIPIO": "D1N",
    "POPULACAO_ESTIMADA": "V",
}


def population_rows(answers: DataFrame) -> DataFrame:
    rows = picked_rows(read_well(answers), POPULATION_COLUMNS)
    return rows.select("COD_MUNICIPIO", "NOME_MUNICIPIO", "ANO", "POPULACAO_ESTIMADA")


def scan_population(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    return population_rows(scan_answers(spark, paths))


def scan_header_first_json(spark: SparkSession, paths: str | Iterable[str], **options) -> DataFrame:
    return labelled_rows(read_well(scan_answers(spark, paths, **options)))
