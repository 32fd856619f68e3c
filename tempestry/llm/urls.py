"""URL filters on a sorted digest array.

The keys of all rules are 64-bit xxHash digests in one sorted array that workers map
into memory; a batch of addresses is probed by one vectorised binary search, and a hit
counts only if the stored rule equals the candidate string.
"""

import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempestry.llm.common import emit

#: Rules of the registered query.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

_LOWER = {a: a + 32 for a in range(65, 91)}


def host_and_path(url):
    """Host (A-Z lower-cased) and path of an address; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    ends = [i for i in (rest.find("?"), rest.find("#")) if i >= 0]
    rest = rest[: min(ends)] if ends else rest
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(_LOWER), path


class DigestArray:
    """Rules as memory-mapped files: sorted digests, and each one's rule string.

    A rule is ``host/path``. Rules of one digest stand side by side and are told apart
    by their strings.
    """

    FILES = ("keys", "ends", "blocked", "lengths", "strings")

    def __init__(self, place):
        """``place`` gives the path of each of ``FILES``."""
        loaded = (np.load(place(name), mmap_mode="r") for name in self.FILES)
        self.keys, self.ends, self.blocked, lengths, self.strings = loaded
        self.lengths = lengths.tolist()

    @staticmethod
    def write(rules, place):
        """Store ``(verdict, rule)`` pairs; of a repeated rule the last one counts."""
        rules = {rule.encode(): verdict == "block" for verdict, rule in rules if "/" in rule}
        texts = sorted(rules, key=lambda r: (xxhash.xxh64_intdigest(r), r))
        for name, values in {
            "keys": np.array([xxhash.xxh64_intdigest(r) for r in texts], dtype=np.uint64),
            "ends": np.cumsum([0, *map(len, texts)], dtype=np.int64),
            "blocked": np.array([rules[r] for r in texts], dtype=bool),
            "lengths": np.array(sorted({len(r.partition(b"/")[2].decode()) + 1 for r in texts}), dtype=np.int64),
            "strings": np.frombuffer(b"".join(texts), dtype=np.uint8),
        }.items():
            np.save(place(name), values)

    def rule(self, i):
        return self.strings[self.ends[i] : self.ends[i + 1]].tobytes()

    def find(self, candidates):
        """For each candidate string the place of the equal rule, or -1."""
        digests = np.fromiter(
            map(xxhash.xxh64_intdigest, candidates), np.uint64, len(candidates)
        )
        at = np.searchsorted(self.keys, digests)
        found = np.full(len(candidates), -1, dtype=np.int64)
        hit = at < len(self.keys)
        hit[hit] = self.keys[at[hit]] == digests[hit]
        for i in np.flatnonzero(hit):
            j = int(at[i])
            while j < len(self.keys) and self.keys[j] == digests[i]:
                if self.rule(j) == candidates[i]:
                    found[i] = j
                    break
                j += 1
        return found

    def candidates(self, host, path):
        """Rules that would fit, longest first (of one length, the longer host first)."""
        labels = host.split(".") if host else []
        hosts = [".".join(labels[i:]) for i in range(len(labels))]
        fitting = [(h, n) for h in hosts for n in self.lengths if n <= len(path)]
        fitting.sort(key=lambda x: (-len(x[0]) - x[1], -len(x[0])))
        return [(h + path[:n]).encode() for h, n in fitting]

    def judge(self, urls):
        """(host, path, rule or None, blocked or None) for each address."""
        places = [host_and_path(u) for u in urls]
        lists = [self.candidates(*p) for p in places]
        distinct = list({c for found in lists for c in found})
        where = dict(zip(distinct, self.find(distinct).tolist()))
        for (host, path), found in zip(places, lists):
            best = next((where[c] for c in found if where[c] >= 0), -1)
            yield host, path, *((None, None) if best < 0 else (self.rule(best).decode(), bool(self.blocked[best])))


_OUT = pa.schema([("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())])


def judge_urls(
    pages: DataFrame, rules=RULES, otherwise="allow", key="page_id", max_bytes=1 << 30
) -> DataFrame:
    """One row per page: its key, host, path, the rule that decides, and the verdict.

    A rule ``host/path`` fits its host and the subdomains of it where the address's path
    starts with the rule's; the longest wins. Addresses that no rule fits are not in the
    array and get ``otherwise``. A null address, or one without ``://``, has an empty
    host and path and fits no rule. Repeated rows are judged alike; other columns are
    ignored. The list is a parameter, not a table that grows with the pages: its files
    are shipped to the executors once, and a list above ``max_bytes`` is refused here,
    ``judge_by_join`` takes it.
    """
    rules = list(rules)
    if sum(len(r) + 24 for _, r in rules) > max_bytes:
        raise ValueError("the rules are larger than max_bytes; use judge_by_join")
    spark = pages.sparkSession
    folder, mark = tempfile.mkdtemp(prefix="rules-"), uuid.uuid4().hex
    DigestArray.write(rules, lambda name: os.path.join(folder, f"{mark}-{name}.npy"))
    for name in DigestArray.FILES:
        spark.sparkContext.addFile(os.path.join(folder, f"{mark}-{name}.npy"))
    kind = pages.schema[key].dataType.simpleString()

    def judge(batches):
        array = DigestArray(lambda name: SparkFiles.get(f"{mark}-{name}.npy"))
        for batch in batches:
            rows = list(array.judge(batch.column("url").to_pylist()))
            host, path, rule, blocked = zip(*rows) if rows else ((), (), (), ())
            verdict = [otherwise if b is None else ("block" if b else "allow") for b in blocked]
            out = emit(_OUT, host=host, path=path, rule=rule, verdict=verdict)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *out.columns], names=[key, *_OUT.names]
            )

    return pages.select(key, "url").mapInArrow(
        judge, f"`{key}` {kind}, host string, path string, rule string, verdict string"
    )


def judge_by_join(pages: DataFrame, rules: DataFrame, otherwise="allow", key="page_id"):
    """``judge_urls`` for a list of any size: ``rules`` has columns verdict and rule.

    Each distinct address meets the rules by a join on the candidate strings.
    """
    lengths = [
        r[0]
        for r in rules.select(F.length("rule") - F.instr("rule", "/") + 1).distinct().collect()
    ]
    places = pages.select("url").distinct().where("url is not null")
    rest = F.regexp_extract("url", r"^(?s:.*?)://([^?#]*)", 1)
    host = F.translate(
        F.regexp_extract(rest, r"^([^/]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    places = places.select("url", host.alias("host"), F.regexp_extract(rest, r"(?s)^[^/]*(.*)", 1).alias("path"))
    labels = F.split("host", r"\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    met = (
        places.withColumn("suffix", F.explode(hosts))
        .withColumn("n", F.explode(F.array(*[F.lit(n) for n in lengths])))
        .where("suffix <> '' and n <= length(path)")
        .select("url", "suffix", F.concat("suffix", F.expr("left(path, n)")).alias("rule"))
        .join(rules, "rule")
        .groupBy("url")
        .agg(F.max(F.struct(F.length("rule"), F.length("suffix"), "rule", "verdict")).alias("best"))
        .select("url", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("said"))
    )
    return (
        pages.select(key, "url")
        .join(places, "url", "left")
        .join(met, "url", "left")
        .select(
            key,
            F.coalesce("host", F.lit("")).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
            "rule",
            F.coalesce("said", F.lit(otherwise)).alias("verdict"),
        )
    )
