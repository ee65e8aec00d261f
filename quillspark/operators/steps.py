"""Chains of steps over subjects, with a ledger that tells what is done.

Each step names the inputs it depends on. Their fingerprints (names, sizes and times of files, or count and hash sum of
a table's rows) are kept with the step's code in a durable table; a step whose inputs haven't changed since it last
ended well is skipped, the first failure ends the chain with its code, and the next run goes on from there. A step that
failed, or that a step before it has run again for, is never skipped.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.config import ConfigError
from quillspark.sources.store import exists

#: Codes that a chain ends with: all well, a step failed, it was called wrongly, the guard stopped it.
OK, FAILED, USAGE, STOPPED = 0, 1, 2, 3
LEDGER = "subject string, step string, place int, fingerprint string, status string, code int, detail string, at timestamp"


@dataclass(frozen=True)
class Step:
    """run takes the subject and gives a code, or None for OK; what it raises is code FAILED. inputs: tables or paths."""

    name: str
    run: Callable[[str], int | None]
    inputs: Sequence[DataFrame | str] = ()


def fingerprint(spark: SparkSession, inputs: Sequence[DataFrame | str]) -> str:
    """A digest of inputs: of a path, its files' names, sizes and times; of a table, the number and a hash sum of its rows."""
    parts = []
    for x in inputs:
        if isinstance(x, DataFrame):
            row = x.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*x.columns)), F.sum(F.xxhash64(F.lit(7), *x.columns) % 1_000_003)).first()
            parts.append(f"table {','.join(x.columns)} {tuple(row)}")
            continue
        p = spark._jvm.org.apache.hadoop.fs.Path(x)
        files = p.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(p):
            parts.append(f"nothing at {x}")
            continue
        found, lines = files.listFiles(p, True), []
        while found.hasNext():
            f = found.next()
            lines.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        parts.append("\n".join(sorted(lines)))
    return hashlib.sha256("\n\n".join(parts).encode()).hexdigest()


class Ledger:
    """What steps have done, at a path. Rows are only appended."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.path) if exists(self.spark, self.path) else self.spark.createDataFrame([], LEDGER)

    def last_good(self, subject: str) -> dict[str, str]:
        """The fingerprint that each of the subject's steps last ended with, of those whose last run ended well."""
        mine = self.rows().where((F.col("subject") == subject) & (F.col("status") != "skipped"))
        last = mine.groupBy("step").agg(F.max_by(F.struct("code", "fingerprint"), F.struct("at", "place")).alias("l")).where(F.col("l.code") == OK)
        return {r.step: r.l.fingerprint for r in last.collect()}  # no more rows than a chain has steps

    def put(self, subject: str, step: str, place: int, mark: str, status: str, code: int, detail: str = "") -> None:
        row = (subject, step, place, mark, status, code, detail[:500], dt.datetime.now())
        self.spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").parquet(self.path)

    def run(self, subject: str, steps: Sequence[Step], again: bool = False) -> int:
        """Run a subject's steps in order and return the code that the chain ends with."""
        good = {} if again else self.last_good(subject)
        changed = False
        for place, step in enumerate(steps):
            mark = fingerprint(self.spark, step.inputs)
            if not changed and good.get(step.name) == mark:
                self.put(subject, step.name, place, mark, "skipped", OK)
                continue
            changed = True
            try:
                code, detail = step.run(subject) or OK, ""
            except Exception as e:
                code, detail = FAILED, f"{type(e).__name__}: {e}"
            self.put(subject, step.name, place, mark, "done" if code == OK else "failed", code, detail)
            if code != OK:
                return code
        return OK


#: Steps of each kind of subject, in order. `guard` stands before the first step that fetches anything.
CHAINS: Mapping[str, Sequence[str]] = {
    "star": ("discover", "guard", "fetch", "texts", "truth", "notes", "retractions"),
    "topic": ("discover", "guard", "fetch", "texts", "notes", "retractions"),
    "web": ("snapshot", "notes"),
    "local-pdfs": ("place", "texts", "notes"),
    "mixed": ("sources", "discover", "guard", "fetch", "texts", "notes", "retractions"),
}


def kind_of(subject: Mapping[str, object]) -> str:
    """The chain of a subject: a star, a topic by its query, or by where its sources are; sources and curated keys make it mixed."""
    if not subject.get("is_topic"):
        return "star"
    source = subject.get("source")
    if source in (None, "ads"):
        if not subject.get("query") and not subject.get("extra_core"):
            raise ConfigError(f"{subject.get('slug')}: a topic needs a query, curated keys or a source")
        return "topic"
    if source not in ("web", "local-pdfs"):
        raise ConfigError(f"{subject.get('slug')}: unknown source '{source}'; there are: ads, web, local-pdfs")
    return "mixed" if subject.get("extra_core") else str(source)


def chain_of(subject: Mapping[str, object], actions: Mapping[str, Step], guard: Callable[[str], bool], yes: bool = False) -> list[Step]:
    """The subject's steps. guard tells whether its core has grown too much; yes goes on all the same.

    A step that no action is given for is an error before anything runs.
    """
    names = CHAINS[kind_of(subject)]
    missing = [n for n in names if n != "guard" and n not in actions]
    if missing:
        raise ConfigError(f"no action for: {', '.join(missing)}")
    stop = Step("guard", lambda slug: STOPPED if guard(slug) and not yes else OK, (*(actions["discover"].inputs if "discover" in actions else ()),))
    return [stop if n == "guard" else actions[n] for n in names]


@dataclass(frozen=True)
class Flags:
    """What a discovery is called with; `check` says what doesn't go together."""

    slug: str | None = None
    topic: bool = False
    probe: str | None = None
    dry_run: bool = False
    extra_only: bool = False
    sweep: bool = False

    def check(self) -> None:
        if self.probe is not None or self.dry_run:
            return
        if not self.slug:
            raise ConfigError("the slug is missing; a probe takes a query instead")
        if self.extra_only and not self.topic:
            raise ConfigError("curated keys alone are for topics: a star always has a query")
        if self.sweep and self.topic:
            raise ConfigError("a sweep of full texts is for stars: a topic has no names to look for")


def called(flags: Flags, use: Callable[[Flags], int]) -> int:
    """use's code, or USAGE for flags or configuration that can't be used."""
    try:
        flags.check()
        return use(flags)
    except ConfigError as e:
        print(e)
        return USAGE
