"""CSV files inside zip archives, read where the tasks are.

Nothing is unpacked to a disk and nothing passes through the driver: Spark
lists the archives, reads their tables of contents, and then streams each
wanted member through one task in small batches.  A deflate stream has to be
read in order by one task, so the lines are shuffled right after it and all
parsing and cleaning runs in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.sources.schema import text_schema

MEMBER_SCHEMA = "archive string, source_zip string, member string, file_name string, bytes bigint"
LINE_SCHEMA = "archive string, source_zip string, line_no bigint, line string"
BATCH_LINES = 20_000


class ArchiveError(ValueError):
    """An archive is not what the job needs."""


def _open_in_task():
    """How a task opens an archive; built here so that it travels by value."""

    def open_archive(path: str):
        import zipfile
        from urllib.parse import quote

        from pyarrow import fs

        # Spark writes file:/x and s3a://x where Arrow wants file:///x and s3://x.
        scheme, _, rest = path.partition(":")
        if scheme in ("s3a", "s3n"):
            scheme = "s3"
        if not rest.startswith("//"):
            rest = "//" + rest
        # Spark gives the path as it is; here it becomes part of an address.
        rest = quote(rest, safe="/:@")
        system, inner = fs.FileSystem.from_uri(f"{scheme}:{rest}")
        return zipfile.ZipFile(system.open_input_file(inner))

    return open_archive


def list_members(spark: SparkSession, glob: str) -> DataFrame:
    """The CSV members of all archives; only tables of contents are read."""
    open_archive = _open_in_task()

    def contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        columns = ["archive", "source_zip", "member", "file_name", "bytes"]
        for batch in batches:
            for path in batch["path"]:
                with open_archive(path) as archive:
                    rows = [
                        (path, path.rsplit("/", 1)[-1], m.filename, m.filename.rsplit("/", 1)[-1], m.file_size)
                        for m in archive.infolist()
                        if m.filename.lower().endswith(".csv")
                    ]
                # An archive without any CSV still shows up, with no member.
                rows = rows or [(path, path.rsplit("/", 1)[-1], None, None, 0)]
                yield pd.DataFrame(rows, columns=columns)

    paths = spark.read.format("binaryFile").load(glob).select("path")
    return paths.mapInPandas(contents, MEMBER_SCHEMA)


def archive_problems(members: DataFrame, required: Sequence[str]) -> DataFrame:
    """What is wrong with each archive; no rows if all is well."""
    wanted = F.array(*[F.lit(name.lower()) for name in required])
    per_archive = members.groupBy("archive").agg(
        F.count("member").alias("members"),
        F.count_distinct(F.lower("file_name")).alias("names"),
        F.collect_set(
            F.when(F.lower("file_name").isin(*[n.lower() for n in required]), F.lower("file_name"))
        ).alias("found"),
    )
    missing = F.array_except(wanted, F.col("found"))
    problem = (
        F.when(F.col("members") == 0, "holds no CSV file")
        .when(F.col("members") > F.col("names"), "holds two files of the same name")
        .when(F.size(missing) > 0, F.concat(F.lit("lacks "), F.concat_ws(", ", missing)))
    )
    return per_archive.select("archive", problem.alias("problem")).filter("problem is not null")


def check_archives(members: DataFrame, required: Sequence[str]) -> None:
    """Raise if any archive is unfit; names the first few and says how many there are."""
    problems = archive_problems(members, required)
    bad = problems.orderBy("archive").limit(10).collect()
    if bad:
        named = "; ".join(f"{row.archive} {row.problem}" for row in bad)
        raise ArchiveError(f"{named} ({len(bad)} of {problems.count()} unfit archives)")


#: Uncompressed bytes that one task reads, unless a single member has more.
TASK_BYTES = 256 << 20


def dealt_by_size(members: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Members over tasks by the bytes that will be read, known from the tables of contents.

    Members are taken by size class (powers of two).  Each class has as many tasks as its bytes fill, and its
    members go round among them, so tasks of a class differ by one member of about the same size; members from
    ``task_bytes`` on have a task each.  The driver sees one row a class.
    """
    classed = members.withColumn("size_class", F.length(F.bin(F.col("bytes"))))
    totals = classed.groupBy("size_class").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("members")).collect()
    first, tasks = {}, 0
    for row in sorted(totals, key=lambda r: r.size_class):
        own = min(row.members, max(1, -(-row.bytes // task_bytes)))
        first[row.size_class], tasks = (tasks, own), tasks + own
    if tasks < 2:
        return members.coalesce(1)
    # Numbered within the listing's own tasks, which take turns at different places.
    turn = Window.partitionBy("size_class", "listed_by").orderBy("archive", "member")
    numbered = classed.withColumn("listed_by", F.spark_partition_id()).withColumn("turn", F.row_number().over(turn))
    seat = F.col("turn") + F.pmod(F.xxhash64("listed_by"), F.lit(1 << 20))
    task = F.lit(None).cast("int")
    for size_class, (begin, own) in first.items():
        task = F.when(F.col("size_class") == size_class, (F.lit(begin) + seat % own).cast("int")).otherwise(task)
    return numbered.withColumn("task", task).repartitionById(tasks, "task").select(*members.columns)


def read_archives(
    spark: SparkSession,
    members: DataFrame,
    file_name: str,
    header: Sequence[str] | None = None,
    sep: str = ",",
) -> DataFrame:
    """The lines of one file in all archives, numbered, without its header.

    Blank lines do not count.  A wrong checksum fails the task, and so does a header with other
    names than ``header``, if that is given.
    """
    wanted_header = None if header is None else [name.lower() for name in header]
    open_archive = _open_in_task()
    batch_lines = BATCH_LINES

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv
        import io

        import pandas as pd

        def batch_of(archive: str, source_zip: str, first: int, texts: list[str]) -> pd.DataFrame:
            return pd.DataFrame(
                {
                    "archive": archive,
                    "source_zip": source_zip,
                    "line_no": range(first, first + len(texts)),
                    "line": texts,
                }
            )

        for batch in batches:
            for row in batch.itertuples(index=False):
                with open_archive(row.archive) as archive, archive.open(row.member) as stream:
                    text = io.TextIOWrapper(stream, encoding="utf-8", errors="replace")
                    filled = (line.rstrip("\n") for line in text if line.strip())
                    found = next(csv.reader([next(filled, "")], delimiter=sep), [])
                    if wanted_header is not None and [n.strip().lower() for n in found] != wanted_header:
                        raise ValueError(f"header of {row.member} in {row.archive} is {found}")
                    number, texts = 1, []
                    for line in filled:
                        texts.append(line)
                        if len(texts) == batch_lines:
                            yield batch_of(row.archive, row.source_zip, number, texts)
                            number, texts = number + len(texts), []
                    if texts:
                        yield batch_of(row.archive, row.source_zip, number, texts)

    wanted = members.filter(F.lower("file_name") == file_name.lower())
    # The lines are spread by their own address, so that a retry sends each one to the same place.
    dealt = dealt_by_size(wanted.select("archive", "source_zip", "member", "bytes"))
    return dealt.select("archive", "source_zip", "member").mapInPandas(lines, LINE_SCHEMA).repartition("archive", "line_no")


def read_archived_csv(
    spark: SparkSession,
    members: DataFrame,
    file_name: str,
    columns: Sequence[str],
    sep: str = ",",
    check_header: bool = False,
) -> DataFrame:
    """One file of all archives as text columns, plus where each row came from.

    Columns are bound by position; ``check_header`` makes other names in a header an error.
    """
    schema = text_schema(columns)
    options = {"sep": sep, "mode": "PERMISSIVE"}
    lines = read_archives(spark, members, file_name, columns if check_header else None, sep)
    row = F.from_csv(F.col("line"), schema.simpleString()[len("struct<") : -1].replace(":", " "), options)
    return lines.select(
        row.alias("row"),
        F.lit(file_name).alias("source_file"),
        "source_zip",
        "line_no",
    ).select("row.*", "source_file", "source_zip", "line_no")
