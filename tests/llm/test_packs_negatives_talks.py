"""Packing by histogram, hard negatives and conversation repair against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from adloom.llm import conversations, histogram_packing, negatives, packing
from adloom.llm.queries import tokenizer

LONG = " ".join(f"word{i}" for i in range(700))
TEXTS = [(1, LONG), (1, LONG), (2, None), (3, ""), (None, "no id"), (4, "x <|endoftext|> y"), (5, "é 中" * 90)]


def gapless(spans):
    at = 0
    for start, length in sorted(spans):
        assert start == at and length > 0
        at += length
    return at


def ids_by_tokenizers(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    return made.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once_without_padding(seed):
    draw = random.Random(seed)
    capacity = (64, 2048, 100)[seed % 3]
    histogram = {n: draw.randint(1, 50) for n in draw.sample(range(1, capacity + 1), draw.randint(1, 40))}
    plan = histogram_packing.plan_packs(histogram, capacity)
    sequences, at = defaultdict(list), 0
    for length in sorted(histogram):
        for place in range(at, at + histogram[length]):
            run = int(np.searchsorted(plan.runs[:, 0], place, "right")) - 1
            first, pattern, each, offset, size = plan.runs[run]
            assert size == length
            copy, k = divmod(place - first, each)
            sequence, fill, line = plan.patterns[pattern]
            inside = offset + k * size
            if line < 0:
                sequences[sequence + copy].append((inside, size))
            else:
                cuts = histogram_packing._cuts(plan.slots, int(line + copy * fill + inside), int(size))
                assert gapless([c[:2] for c in cuts]) == size
                for _, part, number, begin in cuts:
                    sequences[number].append((begin, part))
        at += histogram[length]
    fills = [gapless(v) for v in sequences.values()]
    total = sum(n * c for n, c in histogram.items())
    assert sum(fills) == total and max(fills) <= capacity
    assert all(f == capacity or f & (f - 1) == 0 for f in fills)
    assert len(fills) <= total // capacity + 2 * capacity.bit_length() + sum(f < capacity for f in fills)


def test_packs_are_shortest_first():
    # 6 opens two packs, 3 goes to the emptier one, both packs of a pattern take 2 at once
    assert sorted(histogram_packing.shortest_pack_first({6: 2, 3: 1, 2: 2}, 10)) == sorted(
        [(1, ((6, 1), (3, 1))), (1, ((6, 1), (2, 2)))]
    )


def test_packing_round_trip(spark):
    rows = [(i, t, "x", 1.0) for i, t in TEXTS]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _row string, offset double")
    made = histogram_packing.pack_by_histogram(docs, *tokenizer(), capacity=64, keep_ids=True).collect()
    want = defaultdict(list)
    for i, t in TEXTS:
        want[i].append([*ids_by_tokenizers(t), 1])
    sequences, spans = defaultdict(list), defaultdict(list)
    for r in made:
        part = want[r["doc_id"]][0][r["start"] : r["start"] + r["length"]]
        assert r["ids"] == part and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        assert r["doc_tokens"] == len(want[r["doc_id"]][0])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        spans[r["doc_id"]].append((r["start"], r["length"]))
    fills = [gapless(v) for v in sequences.values()]
    assert all(f == 64 or f < 64 and f & (f - 1) == 0 for f in fills)
    for i, texts in want.items():
        if len(texts) == 1:
            assert gapless(spans[i]) == len(texts[0])
        else:  # two rows of one id: every id is there twice
            assert sum(n for _, n in spans[i]) == 2 * len(texts[0])
    whole = histogram_packing.packed_sequences(docs, *tokenizer(), capacity=64).collect()
    assert sorted(len(r["ids"]) for r in whole) == sorted(fills)
    assert histogram_packing.pack_by_histogram(docs.limit(0), *tokenizer()).count() == 0


def test_long_blanks_are_encoded_whole(spark):
    texts = [(1, " " * 1_000_000), (2, "a" + "\n" * 200_000 + " b"), (3, "　" * 60_000 + "<|endoftext|>")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    counts = dict(packing.pack_documents(docs, *tokenizer()).groupBy("doc_id").sum("length").collect())
    assert counts == {i: len(ids_by_tokenizers(t)) + 1 for i, t in texts}
    checks = {r["doc_id"]: r["ids_crc32"] for r in histogram_packing.pack_by_histogram(docs, *tokenizer()).collect() if r["start"] == 0}
    for i, t in texts:
        first = [*ids_by_tokenizers(t), 1][:2048]
        assert checks[i] == zlib.crc32(np.array(first, "<u4").tobytes())


def mined(rows, positives=5, count=5):
    """Hard negatives of (vec_id, vector, label) rows by comparing all of them."""
    kept = []
    for vec_id, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            shifted = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
            kept.append((vec_id, [int(np.floor(x * 256)) for x in vector], shifted))
    found = []
    for k, (anchor, v, label) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        scored = [
            (sum(a * b for a, b in zip(v, w)), i, own)
            for j, (i, w, own) in enumerate(kept)
            if j != k
        ]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for score, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and 80 * score <= 100 * s[0] <= 100 * score]
            found += [(anchor, positive, r + 1, s[1], score, s[0]) for r, s in enumerate(fits[:count])]
    return sorted(found, key=repr)


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SLICE", 3)
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(6, 8))
    rows = [
        (int(i), [float(np.float32(x)) for x in centres[i % 6] + 0.3 * draw.normal(size=8)], int(draw.integers(0, 4)))
        for i in range(0, 3000, 5)
    ]
    rows += [(100, rows[3][1], 1), (100, rows[3][1], 1), (None, rows[4][1], 2), (200, [], 1), (8, [1.0], 1)]
    rows += [(900, None, 1), (901, [float("nan")], 1), (902, [None, 1.0], 1), (903, [float("inf")], 2), (904, [0.5], None)]
    rows += [(5000 + i, [0.5] * 8, i % 2) for i in range(300)]  # many equal vectors
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, cell string")
    got = sorted(map(tuple, negatives.hard_negatives(table).collect()), key=repr)
    assert got == mined(rows) and len(got) > 300
    assert negatives.hard_negatives(table.limit(0)).count() == 0


def test_pairs_come_in_falling_order():
    draw = np.random.default_rng(2)
    x, y = draw.normal(size=7).round(1), draw.normal(size=5).round(1)
    pairs = list(negatives.multi_sequence(x, y))
    assert sorted((i, j) for _, i, j in pairs) == [(i, j) for i in range(7) for j in range(5)]
    sums = [s for s, _, _ in pairs]
    assert sums == sorted(sums, reverse=True) and all(s == x[i] + y[j] for s, i, j in pairs)


def test_bounds_hold(spark):
    draw = np.random.default_rng(3)
    rows = [(i, draw.integers(-90, 90, 7).tolist(), 0) for i in range(500)]
    table = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "row bigint, vec_id bigint, v array<bigint>, label bigint")
    index = negatives.build_index(table)
    x = np.array([r[1] for r in rows], float)
    first, second = index.bounds(x[:20])
    for r in index.rows.select("row", "cell").collect():
        a, b = divmod(r["cell"], len(index.halves[1]))
        assert (x[:20] @ x[r["row"]] <= first[:, a] + second[:, b]).all()


NEXT = (2, 2, 3, 2)


def cheapest(rows):
    """All edits of (initial, required, truncated) rows, by cost and then by letters."""
    best = None
    todo = [(0, 0, 0, "", ())]
    while todo:
        k, state, cost, audit, lines = todo.pop()
        if best is not None and cost > best[0]:
            continue
        if k == len(rows) and state in (0, 3):
            best = min(best or (cost, audit, lines), (cost, audit, lines))
        if not audit.endswith("II"):
            todo.append((k, NEXT[state], cost + 3, audit + "I", (*lines, (NEXT[state], None))))
        if k < len(rows):
            initial, required, truncated = rows[k]
            todo.append((k + 1, state, cost + 4, audit + "D", lines))
            if not required:
                extra = 3 * truncated
                to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((initial, state))
                if to is not None:
                    todo.append((k + 1, to, cost + extra, audit + "K", (*lines, ("K", k))))
                todo.append((k + 1, NEXT[state], cost + 3 + extra, audit + "R", (*lines, (NEXT[state], k))))
    return best


def repaired_by_search(rows):
    """(turn, role, text) rows of one conversation after damage, sorted."""
    faults, seen, marked = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else None
        fault = fault or ("truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        marked.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    cost, audit, lines = cheapest(marked)
    names = {2: "user", 3: "assistant"}
    text = "\n".join(
        (rows[k][1] if how == "K" else names[how]) + ":" + ("" if k is None else rows[k][2]) for how, k in lines
    )
    return (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def test_repairs_are_cheapest_and_first(spark):
    draw = random.Random(9)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(draw.randint(0, 6)):
            role = draw.choice(["user", "assistant", "system", "user", "assistant", "tool", ""])
            text = draw.choice(["Hi.", "Yes!", "cut off", " \t", "", "é", f"n {turn}?", "Hi. \n"])
            rows.append((conv, draw.choice([None, turn, turn + 2]), role, text, False))
    rows.append((99, 4, "user", "gone", True))
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, dropped boolean")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {r["conv_id"]: tuple(r)[1:] for r in conversations.repaired(table, spill_rows=2).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by_conv = defaultdict(list)
    for conv, *row, dropped in rows:
        by_conv[conv].extend([] if dropped else [row])
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        assert got[conv] == repaired_by_search(own), (conv, own)
    assert got[99][5:] == (0, "", hashlib.sha256(b"").hexdigest()) and len(got) == len(by_conv)

    lines = defaultdict(list)
    repairs = conversations.repaired(table)
    for r in conversations.repaired_turns(table, repairs).collect():
        lines[r["conv_id"]].append((r["position"], f"{r['role']}:{r['text']}"))
    for conv, values in got.items():
        text = "\n".join(line for _, line in sorted(lines[conv]))
        assert hashlib.sha256(text.encode()).hexdigest() == values[-1], conv


def test_damage_keeps_nulls_and_empty_tables(spark):
    rows = [(i % 5 or None, i if i % 3 else None, None if i % 4 == 0 else "user", None if i % 7 == 0 else f"t {i}.", 1) for i in range(60)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, fault int")
    want = []
    for conv, turn, role, text, _ in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        want += [(conv, turn, "user" if fault == 4 else role, text, fault == 0)] * (2 if fault == 3 else 1)
    got = conversations.damaged(table)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert conversations.repaired(conversations.damaged(table.limit(0))).count() == 0
