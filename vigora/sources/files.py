"""Readers and writers of a folder of documents: Markdown, JSON lines, metadata, annexes, tables from outside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Superset of both dialects; never inferred.
UNIT = (
    "id string, norma string, tipo string, path string, vigente boolean, texto string, notas_vigencia array<string>, refs array<string>, "
    "anexos array<string>, fonte string, artigo string, numero_norma string, revisao string, correlacao_ifrs string, secao string, item string, apendice string"
)
META = (
    "tipo string, numero string, ano string, identificador string, ementa string, fonte_arquivo string, sha256_16 string, n_artigos int, "
    "n_artigos_vigentes int, n_redacoes_anteriores int, n_anexos_csv int, n_paginas int, fonte_versao string, atualizado_em string, n_perguntas int, "
    "revisao string, titulo string, correlacao_ifrs string, n_itens int, n_itens_vigentes int, n_itens_apendice int, n_alineas int, n_secoes int, secoes array<string>"
)


def read_units(spark: SparkSession, paths: str) -> DataFrame:
    """JSON lines of units; a line that is no valid JSON comes as ``_corrupt_record``."""
    return spark.read.schema(f"{UNIT}, _corrupt_record string").option("mode", "PERMISSIVE").json(paths)


def read_metas(spark: SparkSession, paths: str) -> DataFrame:
    """Metadata documents, with the folder each comes from."""
    read = spark.read.schema(META).option("multiLine", True).json(paths)
    return read.withColumn("slug", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


def read_texts(spark: SparkSession, paths: str) -> DataFrame:
    """``(path, text)`` of whole text files."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def list_files(spark: SparkSession, folder: str, pattern: str = "*", skip: tuple[str, ...] = ("scripts",)) -> DataFrame:
    """``(folder, name, bytes, modified)`` of the files in the direct children of a folder, sorted, without reading them.

    Children named in ``skip`` and deeper folders are left out.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(f"{folder.rstrip('/')}/*/")
    parts = F.split("path", "/")
    child, name = F.element_at(parts, -2), F.element_at(parts, -1)
    told = files.select(child.alias("folder"), name.alias("name"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    return told.where(~F.col("folder").isin(*skip) if skip else F.lit(True)).orderBy("folder", "name")


def read_binary(spark: SparkSession, paths: str) -> DataFrame:
    """``(path, content, sha256_16)`` of source files, the input of an external text extractor."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", "content", F.left(F.sha2("content", 256), F.lit(16)).alias("sha256_16"))


def read_annexes(spark: SparkSession, paths: str) -> DataFrame:
    """Annex files in long form ``(slug, csv, row_no, header, cells)``; widths differ, so each file is parsed as text."""
    import csv
    import io
    from collections.abc import Iterator

    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("slug", "csv", "row_no", "header", "cells")}
            for path, text in zip(b.column("path").to_pylist(), b.column("text").to_pylist(), strict=True):
                rows = list(csv.reader(io.StringIO(text)))
                parts = path.split("/")
                for n, row in enumerate(rows[1:], 1):
                    for c, v in zip(out, (parts[-3] if len(parts) > 2 else "", parts[-1], n, rows[0], row), strict=True):
                        out[c].append(v)
            kinds = (pa.string(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

    return read_texts(spark, paths).mapInArrow(run, "slug string, csv string, row_no int, header array<string>, cells array<string>")


def read_jdbc(spark: SparkSession, url: str, source: str, key: str, low: int, high: int, partitions: int, **options: str) -> DataFrame:
    """A table, or a query in parentheses with a name, of an outside database, read in ranges of a numeric key; the driver's jar must be
    on the class path. Keys outside ``low`` to ``high`` are read too, by the first and the last partition."""
    bounds = {"partitionColumn": key, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(partitions)}
    return spark.read.format("jdbc").options(url=url, dbtable=source, **bounds, **options).load()


def write_units(units: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines of units; null fields are kept."""
    units.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_by_norm(df: DataFrame, path: str, column: str = "slug", mode: str = "overwrite") -> None:
    """Parquet in one folder per norm, so a later read opens the wanted folder only."""
    df.write.mode(mode).partitionBy(column).parquet(path)


def write_lines(lines: DataFrame, path: str, column: str = "line", mode: str = "overwrite") -> None:
    """Text files of one column in the order of ``lines``."""
    lines.select(column).write.mode(mode).text(path)


def rewrite(df: DataFrame, old: str, new: str) -> None:
    """Write an updated table to a new path; the one it was read from is left as it is."""
    if old.rstrip("/") == new.rstrip("/"):
        raise ValueError("a table cannot overwrite what it is read from")
    df.write.mode("overwrite").parquet(new)


def write_document(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Markdown documents from their rows ``(doc_id, part, place, markdown)``: a folder of text per document, its rows in order."""
    placed = rows.repartition("doc_id").sortWithinPartitions("doc_id", "part", "place")
    placed.select("doc_id", "markdown").write.mode(mode).partitionBy("doc_id").text(path)


def write_annexes(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Annex tables ``(slug, csv, row_no, header, cells)`` in one folder per norm and table, rows in order."""
    placed = rows.repartition("slug", "csv").sortWithinPartitions("slug", "csv", "row_no")
    placed.write.mode(mode).partitionBy("slug", "csv").json(path)


def write_manifest(head: DataFrame, records: DataFrame, path: str) -> None:
    """A manifest: its head, and its entries as JSON lines in order of slug; null paths are kept."""
    head.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/head")
    records.orderBy("slug").write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/normas")
