"""Zip archives of CSV files, written by Spark tasks, for the archive source to read."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Spaces and empty text must come back as they were.
CSV_OPTIONS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_archives(rows: DataFrame, folder: str, file_name: str) -> int:
    """One archive per partition of ``rows``, each with one CSV; gives their number."""
    header = ",".join(rows.columns)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import uuid
        import zipfile

        import pandas as pd
        from pyarrow import fs

        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        system, root = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder)
        system.create_dir(root, recursive=True)
        path = f"{root}/part-{uuid.uuid4().hex}.zip"
        with system.open_output_stream(path) as sink:
            with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
                with archive.open(f"daily/{file_name.upper()}", "w", force_zip64=True) as member:
                    text = io.TextIOWrapper(member, encoding="utf-8", newline="\n")
                    text.write(header + "\n")
                    while first is not None:
                        text.write("\n".join(first["line"]) + "\n")
                        first = next(batches, None)
                    text.flush()
                    text.detach()
        yield pd.DataFrame({"archive": [path]})

    lines = rows.select(F.to_csv(F.struct(*rows.columns), CSV_OPTIONS).alias("line"))
    return lines.mapInPandas(write, "archive string").count()
