"""Texts that repeat words or hold very many tokens; sketches and random spans against brute force."""

import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from adloom.llm import decontamination as d
from adloom.llm import secrets, sketches
from adloom.llm.urlfilter import judge_urls


@pytest.mark.parametrize("seed", range(6))
def test_tiles_by_length_equal_tiles_by_places(seed):
    rng, powers, known = random.Random(seed), d.Powers(), d.WordHashes()
    words = [b"w%d" % i for i in range(rng.choice([1, 2, 3, 8]))]
    text = [rng.choice(words) for _ in range(rng.randrange(5, 160))]
    item = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
    text[20:20] = item[10:30]
    seeds = d.seeds_of([b" ".join(item).decode(), "none of it at all here"])
    hashes = d.hashes_of(text, known)
    ((found, count, places),) = d.seed_matches(d.RunHashes(hashes, powers).of(d.SEED_WORDS), seeds)
    want = {(p, q) for p in range(len(text) - 4) for q in range(len(item) - 4) if text[p : p + 5] == item[q : q + 5]}
    made = list(zip(*(x.tolist() for x in places())))
    assert found == 0 and count == len(made) and set(made) == want
    tiles = d.tiles_of(hashes, seeds.words[0], count, places, powers)
    assert tiles == d.tile_by_length(hashes, seeds.words[0], powers) and tiles


def test_repeated_words_stay_bounded(spark):
    texts = [(1, "spam " * 200_000), (2, "spam ham " * 100_000), (3, "egg " * 9)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "spam " * 1000), (2, "egg " * 1000)], "item_id bigint, text string")
    began = time.monotonic()
    got = d.leaked_pairs(docs, items).select("doc_id", "item_id", "covered_words", "tiles").collect()
    assert [tuple(r) for r in got] == [(1, 1, 1000, "0:0:1000")]
    assert time.monotonic() - began < 30


SCHEMA = "doc_id bigint, text string"


def shingles(text):
    """Hashes by Spark's own function of each shingle's word hashes, all else in Python."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    if not words:
        return []
    return [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))]


def brute_sketches(spark, texts):
    distinct = sorted({s for t in texts for s in shingles(t)})
    if not distinct:
        return {t: set() for t in texts}
    rows = spark.createDataFrame([(list(s),) for s in distinct], "w array<string>")
    words = F.transform("w", lambda w: F.xxhash64(w))
    five = F.xxhash64(*(F.get(words, F.lit(k)) for k in range(5)))
    hashed = rows.select("w", F.when(F.size("w") == 5, five).otherwise(F.xxhash64(words)).alias("h")).collect()
    of = {tuple(r["w"]): r["h"] for r in hashed}
    limit = -(1 << 63) + (1 << 64) // sketches.FRACTION
    out = {}
    for t in texts:
        all_hashes = {of[s] for s in shingles(t)}
        out[t] = {h for h in all_hashes if h < limit} or ({min(all_hashes)} if all_hashes else set())
    return out


@pytest.mark.parametrize("far", [0, 10**15])
def test_sketches_equal_brute_force(spark, far):
    rng = random.Random(3)
    words = [f"Word{i}" for i in range(40)]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 8, 60, 300])))) for i in range(300)]
    texts += [(700 + far, "far Away é"), (5000, texts[9][1]), (5001, None)]
    docs = spark.createDataFrame(texts, SCHEMA)
    order = sorted(((i, t or "") for i, t in texts), reverse=True)
    edited, following = {}, {}
    for k, (i, t) in enumerate(order):
        follower = order[(k + 1) % len(order)][1]
        edited[i] = t[: len(t) - len(t) // 3] + follower[: len(t) // 3]
        following[i] = follower
    own = dict(order)
    sketch = brute_sketches(spark, {*own.values(), *edited.values()})

    def text(hashes):
        return "".join(f"{h % (1 << 64):016x}" for h in sorted(hashes))

    def like(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    want = {
        i: (text(sketch[t]), text(sketch[edited[i]]), like(sketch[t], sketch[edited[i]]), like(sketch[t], sketch[following[i]]))
        for i, t in own.items()
    }
    got = sketches.fingerprints(docs).select("doc_id", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()
    assert {r[0]: tuple(r)[1:] for r in got} == want
    if far:  # ranges by rank: one far id does not put the others together
        ranged = sketches._in_ranges(docs, 8).groupBy("bucket").count().agg(F.max("count")).first()[0]
        assert ranged <= 8


def test_containment_and_merge(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(" ".join(words[:204]), " ".join(words[200:]), " ".join(words), " ".join(words[3:8]), "")]
    df = spark.createDataFrame(rows, "a string, b string, w string, tiny string, e string")
    for c in df.columns:
        df = sketches.with_sketch(df, c, f"s_{c}")
    s = {c: F.col(f"s_{c}") for c in "a b w tiny e".split()}
    out = df.select(
        sketches.containment(s["a"], s["w"]).alias("part"),
        sketches.containment(s["tiny"], s["w"]).alias("tiny"),
        sketches.containment(s["e"], s["w"]).alias("empty"),
        (sketches.merged(s["a"], s["b"]) == s["w"]).alias("merged"),
        sketches.likeness(s["e"], s["e"]).alias("alike"),
    ).first()
    assert out["part"] == 1.0 and out["tiny"] in (None, 1.0) and out["empty"] == 1.0
    assert out["merged"] and out["alike"] == 1.0


def battery(token, alphabet):
    k, n = len(alphabet), len(token)
    x = [alphabet.index(c) + 1 for c in token]
    chi = sum(c * c for c in Counter(x).values()) * k / n - n
    free = k - 1
    z_chi = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free)) if chi > 0 else -9
    high = [v > (k + 1) / 2 for v in x]
    h, changes = sum(high), sum(a != b for a, b in zip(high, high[1:]))
    mean = 2 * h * (n - h) / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    z_runs = (changes + 1 - mean) / math.sqrt(spread) if spread > 0 else math.sqrt(n)
    centred = [v - (k + 1) / 2 for v in x]
    z_serial = sum(a * b for a, b in zip(centred, centred[1:])) / ((k * k - 1) / 12 * math.sqrt(n - 1))

    def tail(z):
        a = abs(z)
        return -(-a * a / 2 + math.log(2 / (a + math.sqrt(a * a + 8 / math.pi)) * math.sqrt(2 / math.pi))) / math.log(10)

    best = max(tail(z_chi) if z_chi > 0 else 0.0, tail(z_runs), tail(z_serial))
    return max(best - math.log10(3), 0.0)


def brute_random(texts):
    """Spans of tokens whose randomness is not rejected, by document."""
    tested = []
    for i, t in texts:
        base = []
        for pattern, group, least in ((secrets.ASSIGN, 2, 8), (r"AKIA[A-Z0-9]+", 0, 16), (r"[0-9a-f]+", 0, 32)):
            base += [m.span() for m in re.finditer(pattern, t) if len(m.group(group)) >= least]
        for m in re.finditer(r"[A-Za-z0-9+/_-]+", t):
            if any(a < m.end() and m.start() < b for a, b in base):
                continue
            for name, alphabet in secrets.ALPHABETS.items():
                if re.match(secrets._FORMS[name], m.group()):
                    break
            else:
                continue
            n = len(m.group())
            if n >= secrets.least_length(len(alphabet)):
                step = min(math.floor(battery(m.group(), alphabet) * secrets.STEPS), secrets.MAX_STEP)
                tested.append((i, m.span(), f"{name}:{math.floor(math.log2(n) * 2)}", step))
    groups, cut = defaultdict(list), {}
    for *_, g, step in tested:
        groups[g].append(step)
    for g, steps in groups.items():
        passed = [s for s in steps if 10 ** (-s / secrets.STEPS) <= secrets.FDR * sum(o >= s for o in steps) / len(steps)]
        cut[g] = min(passed, default=secrets.MAX_STEP + 1)
    out = defaultdict(list)
    for i, span, g, step in tested:
        if step < cut[g]:
            out[i].append(span)
    return out


def random_texts():
    rng = random.Random(11)
    plain = "Section2OfTheThirdPart aaaaaaaaaaaaaaaaaaa1B 000000000000000f /usr/local/lib/python3/Site deadbeefdead00 token=12345678 words".split()
    texts = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(0, 9)):
            alphabet = rng.choice(list(secrets.ALPHABETS.values()))
            words.append("".join(rng.choice(alphabet) for _ in range(rng.randrange(8, 70))))
            words.append(rng.choice(plain))
            if rng.random() < 0.2:
                words.append("é secret: " + words[0])
        texts.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    return texts


def test_random_spans_equal_brute_force(spark):
    texts = random_texts()
    want = brute_random(texts)
    rows = secrets.find_secrets(spark.createDataFrame(texts, SCHEMA), ["doc_id", "text"])
    clean = secrets.redacted(F.col("text"), F.col("spans"))
    found = rows.withColumn("clean", clean).collect()
    for r in found:
        assert [(s["at"], s["until"]) for s in r["spans"] if s["kind"] == 3] == want[r["doc_id"]], r["text"]
        out, end = [], 0
        for s in r["spans"]:
            if s["at"] >= end or not end:
                out += [r["text"][end : s["at"]], "[SECRET]"]
            end = max(end, s["until"])
        assert r["clean"] == "".join(out) + r["text"][end:]
    short = [b - a for spans in want.values() for a, b in spans if b - a < 20]
    assert len(short) > 20 and min(short) == 12


def test_many_tokens_in_a_text(spark, monkeypatch):
    rng = np.random.default_rng(2)
    keys = ["".join(k) for k in rng.choice(list("0123456789abcdef"), (50_000, 34))]
    text = " é ".join(k if i % 3 else f"token={k} {k[:14]}" for i, k in enumerate(keys))
    began = time.monotonic()
    rows = secrets.find_secrets(spark.createDataFrame([(1, text)], SCHEMA), ["doc_id", "text"])
    r = rows.withColumn("clean", secrets.redacted(F.col("text"), F.col("spans"))).first()
    assert sum(s["kind"] == 2 for s in r["spans"]) == 50_000
    assert [(s["at"], s["until"]) for s in r["spans"] if s["kind"] == 2] == [m.span() for m in re.finditer(r"[0-9a-f]{32,}", text)]
    assert r["clean"].count("[SECRET]") >= 50_000 and not re.search("[0-9a-f]{32}", r["clean"])
    assert time.monotonic() - began < 60


def test_hosts_longer_than_any_rule(spark):
    pages = spark.createDataFrame([(1, "http://" + "a." * 50_000 + "com/x"), (2, "http://com/x"), (3, None)], "page_id bigint, url string")
    rules = spark.createDataFrame([("com", "/x", "block")], "host string, path string, action string")
    got = {r["page_id"]: r["verdict"] for r in judge_urls(pages, rules).collect()}
    assert got == {1: "block", 2: "block", 3: "allow"}
    assert judge_urls(pages, rules.limit(0)).where("verdict = 'allow'").count() == 3
