"""Vessel profiles for a stream: stored, refreshed by time, read by vessel.

Computing profiles reads the whole history, and a micro-batch needs those of its own vessels
only. Profiles are kept as versions of a table that is partitioned by vessel; a version is
computed when the last one has grown old, whoever asks and however often, and a batch opens
the folders that its vessels fall into.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatrace.sources.folders import delete, exists, folders

# Fixed value: how long a profile is used before it is looked up again.
PROFILE_TTL_SECONDS = 300
PARTS = 64
SCHEMA = "mmsi int, avg_speed double, speed_std_dev double"


class StoredProfiles:
    """Versions of ``compute()`` below ``path``.

    Call it for all profiles, or ``for_batch`` for those of a batch's vessels. A version that
    a crash left incomplete is not used. The version before the newest stays, as a batch may
    still be reading it.
    """

    def __init__(
        self, spark: SparkSession, path: str, compute: Callable[[], DataFrame],
        ttl_seconds: float = PROFILE_TTL_SECONDS, parts: int = PARTS, clock: Callable[[], float] = time.time,
    ) -> None:
        self.spark, self.path, self.compute = spark, path.rstrip("/"), compute
        self.ttl_seconds, self.parts, self.clock = ttl_seconds, parts, clock

    def _versions(self) -> list[tuple[float, str]]:
        """(time of computation, folder) of the complete versions, oldest first."""
        found = []
        for folder in folders(self.spark, f"{self.path}/version=*"):
            if exists(self.spark, f"{folder}/_SUCCESS"):
                found.append((int(re.search(r"version=(\d+)$", folder)[1]) / 1000, folder))
        return sorted(found)

    def current(self) -> str:
        """Folder of a version that is not too old; computes one if there is none."""
        versions, now = self._versions(), self.clock()
        if versions and now - versions[-1][0] < self.ttl_seconds:
            return versions[-1][1]
        folder = f"{self.path}/version={int(now * 1000)}"
        part = F.pmod("mmsi", F.lit(self.parts))
        rows = self.compute().select("mmsi", "avg_speed", "speed_std_dev").withColumn("part", part)
        rows.repartition("part").write.mode("overwrite").partitionBy("part").parquet(folder)
        for _, old in versions[:-1]:
            delete(self.spark, old)
        return folder

    def _read(self, folder: str, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("basePath", folder).parquet(*paths)

    def __call__(self) -> DataFrame:
        folder = self.current()
        return self._read(folder, folders(self.spark, f"{folder}/part=*"))

    def folders_of(self, batch: DataFrame) -> list[str]:
        """Folders that can hold the profiles of the batch's vessels: ``parts`` at most."""
        folder = self.current()
        rows = batch.filter("mmsi is not null").select(F.pmod("mmsi", F.lit(self.parts)).alias("part"))
        wanted = {f"part={row['part']}" for row in rows.distinct().collect()}
        return [path for path in folders(self.spark, f"{folder}/part=*") if path.rpartition("/")[2] in wanted]

    def for_batch(self, batch: DataFrame) -> DataFrame:
        paths = self.folders_of(batch)
        return self._read(paths[0].rpartition("/")[0] if paths else "", paths)
