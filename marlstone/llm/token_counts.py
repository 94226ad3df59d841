"""Delta-maintained token totals by source, language and tokenizer version.

A batch of signed changes (insert +1, delete -1, revise: the old count out, the new one
in) is summed by key and committed once under its name.  Each attempt writes its sums to a
folder of its own; the commit is the creation of the batch's entry, a small file that names
that folder and that only one writer can create.  A batch whose entry is there already
changes nothing.  Totals are the sums over the committed batches, so the state grows with
batches and keys, never with documents.  ``compact`` folds all committed batches into a
base: the next base file, created by one writer alone, names the folded sums and lists the
batches in them, whose entries stay, so that they are never counted again.

Defined results: null source, lang or tokenizer are keys of their own; null text counts as
empty, a very long one is counted whole; repeated rows count each; keys whose documents and
tokens are both 0 are left out; an empty table commits a batch without sums; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches

KEYS = ["source", "lang", "tokenizer"]
_SUMS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def count_tokens(docs: DataFrame, tokenizer: str, count, provisional=None) -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens, n_provisional for each document.

    ``count(texts)`` and, where given, ``provisional(texts)`` give the counts.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(3).to_pylist()]
            n = pa.array(count(texts), pa.int64())
            guess = pa.array(provisional(texts) if provisional else [None] * len(texts), pa.int64())
            name = pa.array([tokenizer] * batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], name, n, guess], names)

    schema = "doc_id long, source string, lang string, tokenizer string, n_tokens long, n_provisional long"
    names = [f.split()[0] for f in schema.split(", ")]
    return docs.selectExpr(
        "cast(doc_id as long) doc_id", "cast(source as string) source", "cast(lang as string) lang", "cast(text as string) text"
    ).mapInArrow(run, schema)


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).cast("long").alias("docs"), F.col("n_tokens").alias("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("docs"), (-F.col("n_tokens")).alias("tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    return deletes(old).unionByName(inserts(new))


#: How long a writer waits for the entry of another that has taken the name.
CLAIM_SECONDS = 30.0


class Rollup:
    """Committed batches under one folder that all executors share.

    batches/<hash of name>.json   the batch's entry: its name and its sums' folder
    base/<number>.json            the folded sums' folder and the hashes of the batches in it
    sums/<unique>                 sums of one attempt; those that no entry names are dead
    """

    def __init__(self, spark: SparkSession, path: str, claim_seconds: float = CLAIM_SECONDS) -> None:
        self.spark = spark
        self.claim_seconds = claim_seconds
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        root = self._hadoop(self.path)
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for part in ("batches", "base", "sums"):
            self._fs.mkdirs(self._hadoop(f"{self.path}/{part}"))

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _create(self, path: str, body: dict) -> bool:
        """Write a small file that must not be there yet; False where it is.

        The name is taken by an exclusive, empty file first, as a rename onto a file that is there
        replaces it on some stores.  A writer that finds the name taken waits for the file; if
        it does not come, the other has died before its rename, and this one goes on.  Should the other
        only have been slow, either rename leaves one whole file, of the same batch.
        """
        aside = self._hadoop(f"{self.path}/sums/{uuid.uuid4().hex}.json")
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps(body).encode()))
        out.close()
        there = self._hadoop(path)
        claim = self._hadoop(f"{path}.claim")
        try:
            self._fs.create(claim, False).close()
        except Exception as error:  # noqa: BLE001  the one fault that means "taken" has no class of its own here
            if "exist" not in str(error).lower():
                raise
            until = time.monotonic() + self.claim_seconds
            while not (done := self._fs.exists(there)) and time.monotonic() < until:
                time.sleep(0.2)
            if done:
                self._fs.delete(aside, False)
                return False
        return self._fs.rename(aside, there)

    def _read(self, path: str) -> dict:
        lines = self.spark.read.text(path, wholetext=True).collect()
        return json.loads(lines[0].value)

    def _names(self, part: str) -> list[str]:
        found = [str(s.getPath().getName()) for s in self._fs.listStatus(self._hadoop(f"{self.path}/{part}"))]
        return sorted(name[:-5] for name in found if name.endswith(".json"))

    def _place(self, batch: str) -> str:
        return hashlib.sha256(batch.encode()).hexdigest()[:32]

    def committed(self, batch: str) -> bool:
        return self._fs.exists(self._hadoop(f"{self.path}/batches/{self._place(batch)}.json"))

    def _sum(self, rows: DataFrame, docs: str, tokens: str) -> DataFrame:
        return rows.groupBy(*KEYS).agg(F.sum(docs).alias("n_docs"), F.sum(tokens).alias("n_tokens"))

    def _write(self, sums: DataFrame) -> str:
        name = uuid.uuid4().hex
        sums.write.parquet(f"{self.path}/sums/{name}")
        return name

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Sum and commit; False where the batch was committed before, by anyone.

        True and False both mean that the batch's entry stands: an attempt that died before its
        entry did is made good by the next one.
        """
        if self.committed(batch):
            return False
        name = self._write(self._sum(changes, "docs", "tokens"))
        if self._create(f"{self.path}/batches/{self._place(batch)}.json", {"batch": batch, "sums": name}):
            return True
        if not self.committed(batch):
            raise RuntimeError(f"the entry of batch {batch} could not be written")
        self._fs.delete(self._hadoop(f"{self.path}/sums/{name}"), True)
        return False

    def _state(self) -> tuple[list[str], list[str], int]:
        """Folders that count, hashes of the batches in them, and the base's number."""
        bases = self._names("base")
        base = self._read(f"{self.path}/base/{bases[-1]}.json") if bases else {"sums": None, "batches": []}
        folded = set(base["batches"])
        fresh = [name for name in self._names("batches") if name not in folded]
        folders = [base["sums"]] if base["sums"] else []
        if fresh:
            files = [f"{self.path}/batches/{name}.json" for name in fresh]
            folders += [json.loads(r.value)["sums"] for r in self.spark.read.text(files, wholetext=True).collect()]
        return folders, [*base["batches"], *fresh], int(bases[-1]) if bases else -1

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], _SUMS)
        return self.spark.read.schema(_SUMS).parquet(*(f"{self.path}/sums/{name}" for name in folders))

    def totals(self) -> DataFrame:
        rows = self._rows(self._state()[0])
        return self._sum(rows, "n_docs", "n_tokens").where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> bool:
        """Fold all committed batches into a new base; False where another writer did so meanwhile."""
        folders, batches, number = self._state()
        if len(folders) < 2:
            return True
        name = self._write(self._sum(self._rows(folders), "n_docs", "n_tokens").where("n_docs <> 0 or n_tokens <> 0"))
        done = self._create(f"{self.path}/base/{number + 1:012d}.json", {"sums": name, "batches": batches})
        # readers that began before may still read the old sums: they are left to clean_up
        return done

    def clean_up(self) -> int:
        """Delete sums that no entry counts any more; only while nobody reads or writes."""
        live = set(self._state()[0])
        found = [s.getPath() for s in self._fs.listStatus(self._hadoop(f"{self.path}/sums"))]
        dead = [x for x in found if str(x.getName()) not in live]
        for x in dead:
            self._fs.delete(x, True)
        return len(dead)
