"""Suffix trees of repeated word runs against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from adloom.llm import substrings

WINDOW, GRAM = 24, 5


@pytest.fixture(scope="module")
def talk():
    """Texts that share passages of many lengths, some from their start, two words often."""
    rng = random.Random(7)
    passages = [[f"p{k}w{j}" for j in range(rng.randint(20, 70))] for k in range(5)]
    texts = []
    for i in range(40):
        words = []
        for _ in range(rng.randint(0, 4)):
            cut = rng.choice(passages)
            a = rng.randint(0, 8)
            words += cut[a : a + rng.randint(20, 70)]
            words += [rng.choice("xy") for _ in range(rng.randint(0, 40))]
        texts.append((3 * i, " ".join(words)))
    return [*texts, (121, None), (122, ""), (123, texts[4][1]), (None, texts[5][1]), (3, texts[1][1])]


def first_places(texts):
    first = {}
    for i, text in texts:
        words = (text or "").split()
        for at in range(len(words) - WINDOW + 1):
            if i is not None:
                key = tuple(words[at : at + WINDOW])
                first[key] = min(first.get(key, (i, at)), (i, at))
    return first


def expected(texts, copies):
    first, out = first_places(texts), set()
    for i, text in texts:
        if i is None or i in copies:
            continue
        words = (text or "").split()
        runs = []
        for at in range(len(words) - WINDOW + 1):
            doc, place = first[tuple(words[at : at + WINDOW])]
            if doc >= i:
                continue
            for run in runs:
                if run[2] == doc and run[0] + run[1] == at + WINDOW - 1 and run[3] - run[0] == place - at:
                    run[1] += 1
                    break
            else:
                runs.append([at, WINDOW, doc, place])
        out |= {(i, *run) for run in runs}
    return out


@pytest.mark.parametrize("group_rows", [1, 20, substrings.GROUP_ROWS])
def test_long_repeats(spark, talk, group_rows):
    docs = spark.createDataFrame(talk, "doc_id bigint, text string")
    found, copies = substrings.shared_suffixes(docs, WINDOW, GRAM)
    windows = substrings.repeated_windows(found, group_rows)
    rows = substrings.long_repeats(windows, WINDOW).drop("text_key").collect()
    got = {(r["doc_id"], r["start"], r["words"], r["first_doc"], r["first_start"]) for r in rows}
    whole = {r["doc_id"] for r in copies.collect()}
    assert 123 in whole
    assert got == expected(talk, whole) and len(got) > 20
    text = dict(talk)
    for i, start, n, doc, place in got:
        assert text[i].split()[start : start + n] == text[doc].split()[place : place + n]


def test_prefixes_grow_only_where_they_are_hot(spark, talk):
    docs = spark.createDataFrame(talk, "doc_id bigint, text string")
    found, _ = substrings.shared_suffixes(docs, WINDOW, GRAM)
    rows = found.collect()
    assert not any(r["path"] & 0xFFFF for r in rows)  # forty words are more than a window
    text = {i: (t or "").split() for i, t in talk if i is not None}
    for depth, after in ((10, 32), (20, 16)):  # equal paths are equal words, and the other way round
        of = Counter((r["path"] >> after, tuple(text[r["doc_id"]][r["at"] : r["at"] + depth])) for r in rows)
        assert len({h for h, _ in of}) == len({w for _, w in of}) == len(of)


def test_tree_over_batches():
    levels = ["path", "words_high", "words_low"]
    # the last two share prefix and half a digest only; a node goes on over three batches
    leaves = [(1, 5, 5, 2, 0), (1, 5, 5, 2, 9), (1, 5, 5, 4, 1), (1, 5, 5, 4, 7), (1, 5, 6, 8, 0), (2, 5, 6, 9, 0)]
    schema = pa.schema([(n, pa.int64()) for n in [*levels, "doc_id"]] + [("at", pa.int32())])

    def batches(size):
        for k in range(0, len(leaves), size):
            columns = list(zip(*leaves[k : k + size]))
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
            made = pa.record_batch(arrays, schema=schema)
            yield made.append_column("text_key", made["doc_id"])
            yield made.append_column("text_key", made["doc_id"]).slice(0, 0)

    for size in (1, 2, 4, 6):
        out = [r for b in substrings._walk(batches(size)) for r in b.to_pylist()]
        assert [(r["doc_id"], r["at"], r["first_doc"], r["first_at"]) for r in out] == [(4, 1, 2, 0), (4, 7, 2, 0)]
    columns = [np.array([x[k] for x in leaves]) for k in range(3)]
    assert substrings.shared_depth(columns, None).tolist() == [0, 3, 3, 3, 2, 0]
    assert substrings.shared_depth(columns, [1, 5, 5])[0] == 3
