"""Tables of micro-batches: a manifest names the folders that count, and small ones are merged.

A stream writes a folder every few seconds.  Readers list none of them: the manifest names at most
``fan`` folders per tier (and each run's newest batch), because ``fan`` folders of one tier are merged into
one of the next.  A batch counts once the manifest names it, so a batch that failed half-way leaves
nothing, and a retried one replaces itself.  Manifests are numbered files that are never overwritten;
two writers of one table cannot both commit the same number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

FAN = 16
#: manifests, and folders they no longer name, that are kept for readers still at work
KEEP = 8
FILE_BYTES = 128 << 20


class Folder:
    """Small files of one folder, in any store that Spark itself writes to."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self.path = path
        self._at = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _child(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._at, name)

    def names(self) -> list[str]:
        if not self._fs.exists(self._at):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._child(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Fails if the file is there: the one step that decides between two writers."""
        stream = self._fs.create(self._child(name), False)
        stream.write(bytearray(text.encode()))
        stream.close()

    def remove(self, name: str) -> None:
        self._fs.delete(self._child(name), True)

    def bytes(self, name: str) -> int:
        return self._fs.getContentSummary(self._child(name)).getLength()


# ---------------------------------------------------------------- what a manifest says

def joined_spans(spans: list[list]) -> list[list]:
    """[run, first batch, last batch] spans, neighbouring ones of a run joined."""
    out: list[list] = []
    for run, first, last in sorted(spans):
        if out and out[-1][0] == run and first <= out[-1][2] + 1:
            out[-1][2] = max(out[-1][2], last)
        else:
            out.append([run, first, last])
    return out


def covers(entry: dict, run: str, batch_id: int) -> bool:
    return any(r == run and a <= batch_id <= b for r, a, b in entry["spans"])


def to_merge(entries: list[dict], fan: int) -> list[dict]:
    """The entries of the lowest tier that has ``fan`` of them.  A run's newest batch stays: it may be retried."""
    newest: dict[str, int] = {}
    for e in entries:
        for run, _, last in e["spans"]:
            newest[run] = max(newest.get(run, last), last)
    tiers: dict[int, list[dict]] = {}
    for e in entries:
        if e["tier"] or not any(newest[run] == last for run, _, last in e["spans"]):
            tiers.setdefault(e["tier"], []).append(e)
    full = [t for t, es in tiers.items() if len(es) >= fan]
    return tiers[min(full)] if full else []


class BatchTable:
    """Rows of micro-batches below ``path``; ``schema`` declares them without ``run`` and ``batch_id``.

    ``stats`` of a batch (a small dict) live in the manifest; ``merge_stats`` joins those of merged batches.
    """

    def __init__(self, path: str, schema: str, fan: int = FAN,
                 merge_stats: Callable[[list[dict]], dict] = lambda stats: {}) -> None:
        self.path, self.fan, self.merge_stats = path, fan, merge_stats
        declared = [f for f in StructType.fromDDL(schema) if f.name not in ("run", "batch_id")]
        self.names = StructType.fromDDL(schema).names
        self.stored = StructType([*declared, StructField("run", StringType()),
                                  StructField("batch_id", LongType())])

    # ---- manifest

    def _manifest(self, spark: SparkSession) -> tuple[int, dict]:
        folder = Folder(spark, f"{self.path}/_manifest")
        names = folder.names()
        if not names:
            return -1, {"entries": [], "gone": []}
        return int(names[-1].split(".")[0]), json.loads(folder.read(names[-1]))

    def entries(self, spark: SparkSession) -> list[dict]:
        return self._manifest(spark)[1]["entries"]

    def _commit(self, spark: SparkSession, change: Callable[[list[dict]], list[dict]]) -> None:
        number, before = self._manifest(spark)
        after = change(before["entries"])
        left = {e["name"] for e in after}
        gone = before["gone"] + [[number + 1, e["name"]] for e in before["entries"] if e["name"] not in left]
        old = [name for at, name in gone if at <= number - KEEP]
        gone = [g for g in gone if g[0] > number - KEEP]
        folder = Folder(spark, f"{self.path}/_manifest")
        folder.create(f"{number + 1:012d}.json", json.dumps({"entries": after, "gone": gone}))
        data = Folder(spark, self.path)
        for name in old:
            data.remove(name)
        for name in folder.names()[:-KEEP]:
            folder.remove(name)

    # ---- writing

    def has(self, spark: SparkSession, run: str, batch_id: int) -> bool:
        return any(covers(e, run, batch_id) for e in self.entries(spark))

    def write(self, rows: DataFrame, run: str, batch_id: int,
              stats: Callable[[DataFrame], dict] = lambda written: {}) -> None:
        """Store one micro-batch.  A merged batch is older than its run's newest, so it is never retried
        and is left alone.  ``stats`` is asked about the rows as they are written."""
        spark = rows.sparkSession
        if any(e["tier"] and covers(e, run, batch_id) for e in self.entries(spark)):
            return
        placed = rows.drop("run", "batch_id").withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")})
        name = f"batch-{batch_id}-{uuid.uuid4().hex}"
        self._write_batch(placed.select(*self.stored.names), f"{self.path}/{name}")
        entry = {"name": name, "tier": 0, "spans": [[run, batch_id, batch_id]]}
        entry["stats"] = stats(self._rows(spark, [entry]))
        self._commit(spark, lambda es: [e for e in es if not covers(e, run, batch_id)] + [entry])
        self.merge(spark)

    def merge(self, spark: SparkSession) -> None:
        while some := to_merge(self.entries(spark), self.fan):
            names = [e["name"] for e in some]
            name = f"merged-{uuid.uuid4().hex}"
            rows = self._rows(spark, some)
            size = sum(Folder(spark, self.path).bytes(n) for n in names)
            more = self._write_merged(rows, f"{self.path}/{name}", max(1, size // FILE_BYTES))
            entry = {"name": name, "tier": some[0]["tier"] + 1, "stats": self.merge_stats([e["stats"] for e in some]),
                     "spans": joined_spans([s for e in some for s in e["spans"]]), **more}
            self._commit(spark, lambda es: [e for e in es if e["name"] not in names] + [entry])

    def _write_batch(self, rows: DataFrame, path: str) -> None:
        rows.write.parquet(path)

    def _write_merged(self, rows: DataFrame, path: str, files: int) -> dict:
        rows.coalesce(files).write.parquet(path)
        return {}

    # ---- reading

    def _rows(self, spark: SparkSession, entries: list[dict]) -> DataFrame:
        if not entries:
            return spark.createDataFrame([], self.stored)
        # merged folders may be dealt into parts, which are no column
        reader = spark.read.schema(self.stored).option("recursiveFileLookup", "true")
        return reader.parquet(*[f"{self.path}/{e['name']}" for e in entries])

    def read(self, spark: SparkSession, run: bool = False) -> DataFrame:
        """All stored batches; none before the first."""
        return self._rows(spark, self.entries(spark)).select(*self.names, *["run"] * run)

    def read_batch(self, spark: SparkSession, run: str, batch_id: int) -> DataFrame | None:
        """One batch, from the folder that holds it; None if it is not stored."""
        some = [e for e in self.entries(spark) if covers(e, run, batch_id)]
        if not some:
            return None
        rows = self._rows(spark, some).filter((F.col("run") == run) & (F.col("batch_id") == batch_id))
        return rows.select(*self.names)
