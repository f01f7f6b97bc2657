"""URL rules looked up in sorted digest arrays.

Rules are host plus path prefix. Their strings' 64-bit xxHash keys are sorted into arrays
on file, which every executor fetches once and memory-maps, so all its Python workers
share the pages. URLs are judged batch by batch: candidate strings are hashed, found by
vectorised binary search, and confirmed against the stored string, so a collision of
digests never decides. Rules of any number are cut into arrays of bounded size by digest
range; URLs are never shuffled.

A null URL, or one without ``://``, has an empty host and path. Repeated rows are judged
alike; nulls in ``page_id`` are kept; an empty table gives no rows; other columns are
ignored. Rules with a null host or path count them as empty; of two rules for the same
string the one that allows wins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import staged
from adloom.llm.files import (
    attempt_name,
    folder,
    give_to_executors,
    local_file,
    open_output,
)
from adloom.session import work_folder

SEED = 42  # Spark's own xxhash64 uses it, so both sides hash alike
ARRAY_BYTES = 64 * 1024 * 1024
ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, _URL, 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


class DigestArray:
    """A memory-mapped array file: sorted ``key``, with ``text`` and ``payload`` beside it."""

    def __init__(self, path: str):
        rows = pa.ipc.open_file(pa.memory_map(path)).read_all()
        self.keys = (
            rows["key"].chunk(0).to_numpy(zero_copy_only=True)
            if rows.num_rows
            else np.empty(0, np.int64)
        )
        self.text, self.payload = rows["text"], rows["payload"]

    def find(self, texts: list[str], keys: np.ndarray) -> list:
        """Payload of each text, or None."""
        found: list = [None] * len(texts)
        at = np.searchsorted(self.keys, keys)
        last = len(self.keys)
        for i in np.nonzero((at < last) & (self.keys[np.minimum(at, last - 1)] == keys))[0] if last else ():
            k = int(at[i])
            while k < last and self.keys[k] == keys[i]:
                if self.text[k].as_py() == texts[i]:
                    found[i] = self.payload[k].as_py()
                    break
                k += 1
        return found


class DigestArrays:
    """Arrays that split the range of digests between them."""

    def __init__(self, files: tuple[tuple[int, str], ...]):
        self.lowest = np.array([low for low, _ in files], np.int64)
        self.arrays = [DigestArray(local_file(name)) for _, name in files]

    def find(self, texts: list[str]) -> list:
        found: list = [None] * len(texts)
        if not self.arrays or not texts:
            return found
        digests = np.array(
            [xxhash.xxh64_intdigest(t.encode(), SEED) for t in texts], np.uint64
        ).view(np.int64)
        owner = np.maximum(np.searchsorted(self.lowest, digests, side="right") - 1, 0)
        for a in np.unique(owner):
            mine = np.nonzero(owner == a)[0]
            hits = self.arrays[a].find([texts[i] for i in mine], digests[mine])
            for i, payload in zip(mine, hits):
                found[i] = payload
        return found


@lru_cache(maxsize=4)
def _opened(files: tuple[tuple[int, str], ...]) -> DigestArrays:
    return DigestArrays(files)


def build_arrays(entries: DataFrame) -> tuple[tuple[int, str], ...]:
    """Write (text, payload) entries as array files and give them to the executors.

    Spark sorts by digest and each task writes the arrays of its range; only their names
    and lowest digests come back. Texts must be distinct.
    """
    spark = entries.sparkSession
    keyed = staged(entries.select(F.xxhash64("text").alias("key"), "text", "payload"), "digests")
    size = keyed.agg(F.sum(F.octet_length("text") + F.octet_length("payload") + 24)).first()[0]
    parts = 1 + (size or 0) // ARRAY_BYTES
    root = folder(work_folder(spark, "digest-arrays"))
    layout = pa.schema([("key", pa.int64()), ("text", pa.string()), ("payload", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), layout).combine_chunks()  # one bounded array
        if not rows.num_rows:
            return
        name = attempt_name("array", ".arrow")
        with open_output(f"{root}/{name}") as out, pa.ipc.new_file(out, layout) as sink:
            sink.write_table(rows, max_chunksize=rows.num_rows)
        yield pa.record_batch({"low": [rows["key"][0].as_py()], "name": [name]})

    ranges = keyed.repartitionByRange(parts, "key").sortWithinPartitions("key", "text")
    files = staged(ranges.mapInArrow(write, "low bigint, name string"), "digest-files")
    made = sorted((r["low"], r["name"]) for r in files.collect())  # one row per 64 MB of rules
    for _, name in made:
        give_to_executors(spark, f"{root}/{name}")
    return tuple(made)


def _path_lengths(payload: bytes) -> Iterable[int]:
    """Longest first."""
    return np.frombuffer(payload, "<u4")[::-1].tolist()


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """Per page its host, path, the longest rule that fits and the verdict.

    ``rules`` has host, path and action ('allow' or 'block'). A rule fits its host and
    all subdomains where the URL's path starts with the rule's. URLs that no array holds
    a rule for get ``default``.
    """
    clean = rules.select(
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "action",
    )
    by_rule = clean.groupBy(F.concat("host", "path").alias("text"), "host").agg(
        F.min("action").alias("action")
    )
    full = build_arrays(
        by_rule.groupBy("text").agg(F.to_binary(F.min("action"), F.lit("utf-8")).alias("payload"))
    )

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.array(x, "<u4").tobytes() for x in batch["lengths"].to_pylist()]
            yield pa.record_batch(
                {"text": batch["host"], "payload": pa.array(packed, pa.binary())}
            )

    hosts = build_arrays(
        clean.groupBy("host")
        .agg(F.array_sort(F.collect_set(F.char_length("path"))).alias("lengths"))
        .mapInArrow(lengths, "text string, payload binary")
    )

    longest = clean.agg(F.max(F.char_length("host"))).first()[0] or 0

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule_arrays, host_arrays = _opened(full), _opened(hosts)
        for batch in batches:
            urls = list(zip(batch["host"].to_pylist(), batch["path"].to_pylist()))
            suffixes = [(i, s) for i, (host, _) in enumerate(urls) for s in _suffixes(host, longest)]
            hits = host_arrays.find([s for _, s in suffixes])
            tried = [
                (len(s) + n, i, s + urls[i][1][:n])
                for (i, s), payload in zip(suffixes, hits)
                if payload is not None
                for n in _path_lengths(payload)
                if n <= len(urls[i][1])
            ]
            tried.sort(key=lambda c: -c[0])
            rule: list = [None] * len(urls)
            verdict = [default] * len(urls)
            for (_, i, text), action in zip(tried, rule_arrays.find([c[2] for c in tried])):
                if action is not None and rule[i] is None:
                    rule[i], verdict[i] = text, action.decode()
            yield pa.record_batch(
                {
                    "page_id": batch["page_id"],
                    "host": batch["host"],
                    "path": batch["path"],
                    "rule": pa.array(rule, pa.string()),
                    "verdict": pa.array(verdict, pa.string()),
                }
            )

    url = F.col("url")
    seen = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    kind = dict(pages.dtypes)["page_id"]
    return seen.mapInArrow(
        judge, f"page_id {kind}, host string, path string, rule string, verdict string"
    )


def _suffixes(host: str, longest: int) -> list[str]:
    """The host and its parent domains, none longer than any rule's host."""
    found = [host] if len(host) <= longest else []
    at = host.find(".", max(0, len(host) - longest - 1))
    while at >= 0:
        found.append(host[at + 1 :])
        at = host.find(".", at + 1)
    return found
