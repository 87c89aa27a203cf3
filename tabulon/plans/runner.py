"""Studies that survive a crash (S4, S6, D1-D9): finished parts are tables.

A study is a set of named parts, one per configuration. Each part's result is
written under the fingerprint of the study's settings and data, and counts as
finished once Spark's writer has committed it. A study that is started again
computes the missing parts only, and queries that need the same parts share
them. Another setting or other data has another fingerprint, so nothing stale
is reused."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def data_fingerprint(df: DataFrame) -> str:
    """Row count and order-free hash of all rows, in one aggregate."""
    h = F.xxhash64(*df.columns).cast("decimal(38,0)")
    return "-".join(str(x) for x in df.agg(F.count(F.lit(1)), F.sum(h), F.sum(F.crc32(h.cast("string")))).first())


class Study:
    """Parts of one study below ``path`` (default: the shared checkpoint folder,
    which lasts as long as the session's; name a lasting one to resume later)."""

    def __init__(self, spark: SparkSession, name: str, settings: dict, data: DataFrame, path: str | None = None):
        key = json.dumps([settings, data_fingerprint(data)], sort_keys=True, default=str)
        root = path or f"{ensure_checkpoint_dir(spark)}/studies"
        self.spark = spark
        self.at = f"{root}/{name}-{hashlib.sha256(key.encode()).hexdigest()[:20]}"

    def _path(self, part: str) -> str:
        return f"{self.at}/studypart={hashlib.sha256(part.encode()).hexdigest()[:20]}"

    def finished(self, part: str) -> bool:
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._path(part)}/_SUCCESS")
        return done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done)

    def run(self, parts: dict[str, Callable[[], DataFrame]], threads: int = 1) -> DataFrame:
        """The parts' rows in one table; parts not finished yet are computed, up
        to ``threads`` at a time. An error in one part leaves the finished ones stored."""
        def one(part: str) -> None:
            if not self.finished(part):
                parts[part]().write.mode("overwrite").parquet(self._path(part))

        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            for future in [pool.submit(one, p) for p in parts]:
                future.result()
        # the option keeps the folder names of the parts out of the columns
        return self.spark.read.option("basePath", self.at).parquet(*[self._path(p) for p in parts]).drop("studypart")
