"""Secret scans with corpus-wide ownership.

Every text is searched for three fixed kinds of secret and for opaque
strings. Each found value is hashed, and over the whole corpus the distinct
repositories and owners that hold the hash are counted. A value that many
owners hold is a copied example; one that few hold, and that looks random, is
live. Opaque strings only count as secrets when they are live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.staging import written

#: Kinds in the order that breaks ties of spans with equal starts.
KINDS = ("assign", "access", "hex", "opaque")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs shorter than 24 fail; a run of 24 or more starts where [0-9a-f]+ does
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: A value found with more owners than this, or in more repositories, is a copied example.
MAX_OWNERS = 3
MAX_REPOSITORIES = 50
#: Bits a character: random base64 or hex of 20 characters is above, words and counters are below.
MIN_ENTROPY = 3.0


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def looks_random(value: str) -> bool:
    """Digits and letters mixed, and enough different characters."""
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and entropy(value) >= MIN_ENTROPY


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the three fixed kinds, by start and kind; spans are the whole matches."""
    out = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), m[2]))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                out.append((m.start(), 1, m.end(), m[0]))
    for m in HEX.finditer(text):
        out.append((m.start(), 2, m.end(), m[0]))
    out.sort(key=lambda s: s[:2])
    return out


def opaque_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Random-looking strings that no base span touches."""
    out = []
    for m in OPAQUE.finditer(text):
        if looks_random(m[0]) and not any(s < m.end() and m.start() < e for s, _, e, _ in base):
            out.append((m.start(), 3, m.end(), m[0]))
    return out


def value_hash(value: str) -> int:
    return int.from_bytes(hashlib.sha256(value.encode()).digest()[:8], "big", signed=True)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            rows = []
            for text in part.column(2).to_pylist():
                base = base_spans(text or "")
                found = sorted(base + opaque_spans(text or "", base), key=lambda s: s[:2])
                rows.append([{"start": s, "kind": k, "end": e, "hash": value_hash(v), "random": looks_random(v)} for s, k, e, v in found])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(3), pa.array(rows, pa.list_(pa.struct(
                    [("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("hash", pa.int64()), ("random", pa.bool_())])))],
                ["repo", "owner", "text_key", "found"])


def candidates(docs: DataFrame, text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """(repo, owner, text_key, found): every row of the input with its spans, in one pass over the texts."""
    d = docs.select(F.col(repo_col).alias("repo"), F.col(owner_col).cast("string").alias("owner"),
                    F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
    repo = d.schema["repo"].dataType.simpleString()
    return d.mapInArrow(_scan, f"repo {repo}, owner string, text_key bigint, "
                               "found array<struct<start:int,kind:int,end:int,hash:bigint,random:boolean>>")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos): distinct owners and repositories of each value.

    Counted in two steps with map-side aggregation, so a value that a third of
    the corpus holds reaches each reducer as one partial row a task. A null
    owner or repository counts as one of its own.
    """
    spans = found.select("repo", "owner", F.explode("found").alias("s")).select("repo", "owner", F.col("s.hash").alias("hash"))
    pairs = spans.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    owners = pairs.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return owners.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repos"))


def scan(docs: DataFrame, text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source",
         max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOSITORIES) -> DataFrame:
    """(repo, text_key, spans): one row per input row, spans with their verdicts, by start and kind.

    A span is (start, end, kind, n_owners, n_repos, verdict); offsets are code
    points, ends exclusive. The verdict is ``example`` (more than
    ``max_owners`` owners or ``max_repos`` repositories), ``live`` (fewer, and
    random-looking) or ``plain``. Opaque strings that aren't live are left out.

    Null texts count as empty; null or repeated ids and repeated rows keep a
    row each; an empty table gives no rows. Equal starts are ordered by kind.
    """
    found = written(candidates(docs, text_col, repo_col, owner_col).withColumn("rid", F.monotonically_increasing_id()), "secret-spans")
    owned = ownership(found)
    spans = found.where(F.size("found") > 0).select("rid", F.explode("found").alias("s")).select("rid", "s.*")
    copied = (F.col("n_owners") > max_owners) | (F.col("n_repos") > max_repos)
    verdict = F.when(copied, "example").when(F.col("random"), "live").otherwise("plain")
    judged = (spans.join(owned, "hash").withColumn("verdict", verdict)
              .where((F.col("kind") != KINDS.index("opaque")) | (F.col("verdict") == "live")))
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    gathered = judged.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct(
        "start", "kind", "end", "n_owners", "n_repos", "verdict", kind.alias("name")))).alias("spans"))
    out = found.select("rid", "repo", "text_key").join(gathered, "rid", "left")
    spans_type = gathered.schema["spans"].dataType.simpleString()
    return out.select("repo", "text_key", F.coalesce("spans", F.array().cast(spans_type)).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns of ``scan``'s rows, and what ownership said."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")

    def count(test):
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(k):
        return count(lambda s: s["kind"] == k).alias(f"n_{KINDS[k]}")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return scanned.select(
        F.col("repo").alias("doc_id"), *[of_kind(k) for k in range(3)],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        count(lambda s: s["verdict"] == "live").alias("n_live"), count(lambda s: s["verdict"] == "example").alias("n_example"))


def redact(docs: DataFrame, text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source",
           chars_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs``; live spans become ``mark``, and ``chars_col`` is counted anew where a text changed.

    Rows are matched by id and text, so repeated ids with other texts keep
    their own spans. Documents without a live span are unchanged.
    """
    live = (scan(docs, text_col, repo_col, owner_col)
            .select("repo", "text_key", F.filter("spans", lambda s: s["verdict"] == "live").alias("live"))
            .where(F.size("live") > 0)
            .select("repo", "text_key", F.transform("live", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("live"))
            .dropDuplicates(["repo", "text_key"]))
    rows = docs.select(F.struct("*").alias("d"), F.col(repo_col).alias("id"), F.xxhash64(text_col).alias("key"))
    hit = rows.join(live, rows["id"].eqNullSafe(live["repo"]) & (rows["key"] == live["text_key"]), "left")
    text = F.col("d")[text_col]
    merged = F.aggregate(
        "live", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
            .otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at")),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    changed = F.col("live").isNotNull()
    new = {text_col: merged, chars_col: F.length(merged)}
    return hit.select(*[
        F.when(changed, new[c].cast(docs.schema[c].dataType)).otherwise(F.col("d")[c]).alias(c) if c in new
        else F.col("d")[c].alias(c) for c in docs.columns])
