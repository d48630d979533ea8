"""File access inside tasks, for any file system pyarrow can open from a URI or an absolute path.

Spark's own file sources skip names that start with an underscore, which is how session folders and
archives are named here; so tasks list and read the files themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from stagewatch.functions.durable import durable

BATCH = 20_000
LISTED = "site_code string, case_id string, relative_path string, path string"


def open_root(root: str):
    """(file system, base path without trailing slash)."""
    from pyarrow.fs import FileSystem

    system, base = FileSystem.from_uri(root)
    return system, base.rstrip("/")


def read_bytes(system, path: str) -> bytes:
    with system.open_input_stream(path) as stream:
        return stream.read()


def _entries(system, folder: str, recursive: bool = False):
    from pyarrow.fs import FileSelector

    return system.get_file_info(FileSelector(folder, recursive=recursive))


def _folders(system, folder: str) -> list[str]:
    from pyarrow.fs import FileType

    return sorted(e.base_name for e in _entries(system, folder) if e.type == FileType.Directory)


def spread(df: DataFrame, *keys: str, files_per_task: int = 16) -> DataFrame:
    """Enough tasks for work that is one file or folder per row; row bytes say nothing about it here."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // files_per_task))
    return df.repartition(tasks, *keys)


def list_case_files(spark: SparkSession, root: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """Every file below ``root/<site>/<case>/``; a case folder without files gives one row of NULL paths.

    Only site names pass through the driver: the cases of a site are listed by one task, and the
    files of a case by another.
    """
    def cases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = open_root(root)
        for batch in batches:
            for site in batch["site_code"]:
                names = [n for n in _folders(system, f"{base}/{site}") if n not in skip]
                for at in range(0, len(names), BATCH):
                    part = names[at:at + BATCH]
                    yield pd.DataFrame({"site_code": [site] * len(part), "case_id": part})

    def files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileType

        system, base = open_root(root)
        for batch in batches:
            for site, case in zip(batch["site_code"], batch["case_id"]):
                top = f"{base}/{site}/{case}"
                paths = [e.path for e in _entries(system, top, recursive=True) if e.type == FileType.File] or [None]
                yield pd.DataFrame({
                    "site_code": [site] * len(paths), "case_id": [case] * len(paths),
                    "relative_path": [p and p[len(top) + 1:] for p in paths], "path": paths,
                }, dtype=object)

    system, base = open_root(root)
    sites = spark.createDataFrame([(s,) for s in _folders(system, base)], "site_code string")
    # Both listings are names only and are read several times; folders may change in between.
    found = durable(sites.repartition("site_code").mapInPandas(cases, "site_code string, case_id string"))
    return durable(spread(found, "site_code", "case_id").mapInPandas(files, LISTED))
