"""Fingerprints, fill-in-the-middle and hard negatives against brute force, with odd rows."""

import hashlib
import math
import re
import struct
import unicodedata

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from cellscape.llm import class_lm, fim, fingerprints, hard_negatives, lang_zstd, queries
from cellscape.llm.common import with_next

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, fim_ string, row string, made int, fp_words int, next_key int, label int"
LONG = "wörter   mit  \n\n\t leer\x0bzeichen\x1cund mehr \U0001f600 <b> " * 3000
ODD = [
    (1, None), (2, ""), (3, "one"), (3, "one"), (4, " \n one two"), (None, "one two three four five"), (None, None), (5, LONG), (6, "a b c d e f g"),
    (7, "x <P> y"), (8, "<<S<M"), (9, "<"), (10, "P>a<"), (11, "<S"), (12, "a b c d e f g"), (13, "\t\n "),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "f", "r", 1, 2, 3, 4) for i, t in ODD], SCHEMA)


def long_hash(values, fmt, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack(fmt, v) if isinstance(fmt, str) else v, seed)
    return seed


def slow_fingerprint(text, p=fingerprints.Params()):
    words = re.split(r"[\x20\x09-\x0D]+", (text or "").lower().strip(" \t\n\x0b\x0c\r"))
    if words == [""]:
        return [0] * p.bins
    bins = {}
    for i in range(max(1, len(words) - p.width + 1)):
        h = 42
        for w in words[i : i + p.width]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        h -= (1 << 64) if h >> 63 else 0
        b = (h >> p.shift) + p.bins // 2
        bins[b] = min(h, bins.get(b, h))
    out = []
    for j in range(p.bins):
        def place(i):
            h = long_hash([p.seed, j, i], "<i")  # noqa: B023
            return h - (1 << 64) if h >> 63 else h

        v = bins[j] if j in bins else bins[min(bins, key=place)]
        mixed = xxhash.xxh64_intdigest(struct.pack("<i", j), xxhash.xxh64_intdigest(struct.pack("<q", v), 42))
        out.append(mixed & ((1 << p.bits) - 1))
    return out


def digits(bits):
    return "".join(f"{b:x}" for b in bits)


def test_fingerprints_match_brute_force(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(40).unionByName(odd.select("doc_id", "text"))
    got = fingerprints.with_fingerprint(docs, F.col("text"), "fp").select("text", fingerprints.as_text(F.col("fp")).alias("fp")).collect()
    assert len(got) == 40 + len(ODD)
    assert all(r["fp"] == digits(slow_fingerprint(r["text"])) for r in got)


def test_fingerprint_keeps_columns_and_takes_other_sizes(spark, odd):
    p = fingerprints.Params(width=2, bins=32, bits=8, probes=2)
    out = fingerprints.with_fingerprint(odd, F.col("text"), "fp", p)
    assert out.columns == [*odd.columns, "fp"]
    for r in out.select("text", fingerprints.as_text(F.col("fp")).alias("fp")).collect():
        assert r["fp"] == "".join(f"{b:02x}" for b in slow_fingerprint(r["text"], p))
    assert fingerprints.with_fingerprint(odd.limit(0), F.col("text"), "fp").count() == 0


def test_likeness_estimates_jaccard(spark):
    """Pairs that share a stated part of their shingles; also few shingles, where most bins are filled from others."""
    rng, rows = np.random.default_rng(3), []
    for n in (8, 40, 400, 3000):
        for share in (0.0, 0.3, 0.8, 1.0):
            for k in range(12):
                same = [f"{k}w{x}" for x in rng.integers(0, 1 << 40, int(n * share) + 4)]
                a, b = ([f"{k}{s}{x}" for x in rng.integers(0, 1 << 40, n - int(n * share))] for s in "ab")
                a, b = [*same, *a], [*same, *b]
                shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
                j = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
                rows.append((n, share, j, " ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "n int, share double, j double, a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, F.col("a"), "x"), F.col("b"), "y")
    got = df.select("n", "share", "j", fingerprints.likeness(F.col("x"), F.col("y")).alias("e")).collect()
    assert all(r["e"] == 1.0 for r in got if r["j"] == 1.0)
    for n in (8, 40, 400, 3000):
        for share in (0.0, 0.3, 0.8):
            errors = [r["e"] - r["j"] for r in got if (r["n"], r["share"]) == (n, share)]
            assert abs(np.mean(errors)) < (0.12 if n == 8 else 0.04), (n, share)
            assert max(map(abs, errors)) < (0.5 if n == 8 else 0.25 if n == 40 else 0.15), (n, share)


def test_wordless_texts_are_alike_and_unlike_others(spark):
    df = spark.createDataFrame([("", " \n"), ("", "a"), ("a b", None)], "a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, F.col("a"), "x"), F.col("b"), "y")
    assert [r[0] for r in df.select(fingerprints.likeness(F.col("x"), F.col("y"))).collect()] == [1.0, 0.0, 0.0]


def test_next_row_over_many_ranges(spark, tmp_path):
    """Scattered, repeated and null ids over files; every row is followed by the next one, the last by the first."""
    ids = [None, None, *([7] * 300), *range(1000, 400, -1)]
    spark.createDataFrame([(i, f"t{k}", 0) for k, i in enumerate(ids)], "doc_id long, text string, next_key int").repartition(5).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    got = with_next(docs, ["doc_id"], ["doc_id", "text"], "after").collect()
    assert sorted(r["text"] for r in got) == sorted(f"t{k}" for k in range(len(ids)))
    follows = {r["text"]: r["after"] for r in got}
    at, seen = got[0]["text"], []
    for _ in got:
        seen.append(at)
        at = follows[at]["text"]
    assert at == seen[0] and len(set(seen)) == len(ids)  # one round through all rows
    own = {r["text"]: r["doc_id"] for r in got}
    steps = [(own[t], follows[t]["doc_id"]) for t in seen]
    rank = lambda x: -1 if x is None else x
    assert sum(rank(a) > rank(b) for a, b in steps) == 1  # only the last goes back
    one = with_next(docs.where("doc_id = 555"), ["doc_id"], ["doc_id"], "after").collect()
    assert [(r["doc_id"], r["after"]["doc_id"]) for r in one] == [(555, 555)]
    assert with_next(docs.where("doc_id = 3"), ["doc_id"], ["doc_id"], "after").count() == 0


def test_fingerprint_query_matches_brute_force(spark):
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in queries.op11_fingerprints(spark, SF).collect()}
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        m = len(text) // 4
        edited = text[: len(text) - m] + after[:m]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        if k % 20 == 0:
            mine, other = slow_fingerprint(text), slow_fingerprint(edited)
            assert (got[i]["fingerprint"], got[i]["edited_fingerprint"]) == (digits(mine), digits(other))
            same = sum(a == b for a, b in zip(mine, other)) / 256
            assert got[i]["near_edited"] == pytest.approx(max(0, (same - 1 / 16) / (15 / 16)))


def slow_fim(doc_id, text):
    text = text or ""
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(u), "plain", None, None, text
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    return (len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_fim_matches_brute_force(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    many = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("<S"), F.substring(F.lit("ab<P é 日本 c<"), 1, (F.col("id") % 14).cast("int")), F.lit("M>"), F.lit("<")).alias("text"))
    for rows in (docs, odd, many):
        got = fim.transform(rows)
        assert got.columns == [*rows.columns, "fim"]
        for r in got.select("doc_id", "text", "fim", fim.restored(F.col("fim.output"), F.col("fim.form")).alias("back")).collect():
            assert tuple(r["fim"]) == slow_fim(r["doc_id"], r["text"])
            assert r["back"] == (r["text"] or "")
    assert fim.transform(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fim.transform(odd.withColumn("FIM", F.lit(1)))


def test_rank_and_select():
    rng = np.random.default_rng(5)
    for n, share in ((0, 0), (1, 1), (511, 0.5), (512, 1), (513, 0.01), (5000, 0.3)):
        flags = rng.random(n) < share
        bits, at = fim.Bits(flags), np.flatnonzero(flags)
        assert bits.total == len(at)
        assert [bits.select(k) for k in range(len(at))] == at.tolist()
        assert all(bits.rank(p) == flags[:p].sum() for p in range(0, n, 7))


def slow_negatives(rows, anchors, p=hard_negatives.Params()):
    """From (id, label, whole numbers) that take part."""
    out = []
    for k, (i, label, v) in enumerate(rows):
        if i not in anchors:
            continue
        order = sorted(((-sum(a * b for a, b in zip(v, w)), j, m == label) for n, (j, m, w) in enumerate(rows) if n != k and len(w) == len(v)), key=lambda x: x[:2])
        for s, j, _ in [x for x in order if x[2]][: p.positives]:
            fit = [(t, m) for t, m, same in order if not same and p.low * -s <= 100 * -t <= p.high * -s][: p.negatives]
            out += [(i, j, r, m, -s, -t) for r, (t, m) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [3, 64, 2048])
def test_hard_negatives_match_brute_force(spark, size):
    """Many ties, few and many blocks, other dimensions, repeated ids, and rows that take no part."""
    rng = np.random.default_rng(size)
    rows = [(int(i), int(rng.integers(0, 4)), [float(x) for x in rng.integers(-2, 6, 4) / 256]) for i in range(150)]
    rows += [(200 + i, 1, [0.5, 0.25]) for i in range(6)] + [(300 + i, 2, [0.5, 0.25 - i / 256]) for i in range(6)]
    rows += [rows[5], rows[7], (3, 3, rows[3][2])]
    odd = [(400, None, [1.0] * 4), (401, 1, None), (402, 1, []), (403, 1, [1.0, None, 1.0, 1.0]), (404, 1, [float("nan")] * 4), (405, 1, [float("inf")] * 4), (None, 1, [1.0] * 4)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], "vec_id long, label int, embedding array<double>, row string, block int")
    p = hard_negatives.Params(rows=size, anchors=max(2, size // 8))
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, params=p).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    whole = [(i, m, [int(np.floor(x * 256)) for x in v]) for i, m, v in rows]
    assert sorted(map(tuple, got.collect())) == slow_negatives(whole, {i for i, _, _ in rows if i % 10 == 0})


@pytest.mark.parametrize("times", [1, 2**12, 2**24])
def test_hard_negatives_of_large_numbers_and_one_label_each(spark, times):
    """Scores beyond floats and beyond doubles, below zero too, many labels of few rows."""
    rng = np.random.default_rng(times)
    rows = [(int(i), int(i % 40), [float(x) * times / 256 for x in rng.integers(-3, 6, 3)]) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    p = hard_negatives.Params(rows=16, anchors=4)
    got = hard_negatives.mine(df, F.col("vec_id") % 3 == 0, params=p).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    whole = [(i, m, [int(np.floor(x * 256)) for x in v]) for i, m, v in rows]
    assert sorted(map(tuple, got.collect())) == slow_negatives(whole, {i for i, _, _ in rows if i % 3 == 0})


def test_hard_negatives_leave_a_task_once(spark, monkeypatch):
    """What is merged grows with the tasks and with what is asked for, not with the blocks of rows, and blocks aren't copied."""
    seen, first = [], hard_negatives.first
    monkeypatch.setattr(hard_negatives, "first", lambda found, *rest: (seen.append(found), first(found, *rest))[1])
    rng = np.random.default_rng(2)
    rows = [(int(i), int(i % 2), [float(x) for x in rng.integers(1, 3, 3) / 256]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    hard_negatives.mine(df, F.col("vec_id") % 40 == 0, params=hard_negatives.Params(rows=8, anchors=5, low=1)).collect()
    positives, negatives = (found.count() for found in seen)
    assert positives <= 4 * 10 * 5 and negatives <= 4 * 50 * 5  # four tasks, ten anchors; fifty blocks of rows
    assert all("CartesianProduct" in found._jdf.queryExecution().executedPlan().toString() for found in seen)


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([(1, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") > 0).count() == 0
    assert hard_negatives.mine(df, F.col("vec_id") > 5).count() == 0
    assert hard_negatives.mine(df, F.col("vec_id") > 0).count() == 0


def test_scores_beyond_doubles_are_exact():
    a = np.array([[2.0**30, 1.0], [3.0, 5.0]])
    x = np.array([[2.0**25, 1.0], [2.0**24 + 1, 7.0]])
    assert hard_negatives.scores(a, x).tolist() == [[2**55 + 1, 2**54 + 2**30 + 7], [3 * 2**25 + 5, 3 * (2**24 + 1) + 35]]
    with pytest.raises(OverflowError):
        hard_negatives.scores(a * 2.0**30, x)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_classes(texts, p):
    """Exchange clustering over plain dictionaries: every move by the likelihood itself, batches from one state, halved where they lose."""
    from collections import Counter

    counts = Counter(w for t in texts for w in split(t))
    words = [w for w, c in sorted(counts.items(), key=lambda x: (-x[1], x[0])) if c >= p.least]
    rank = {w: i + 1 for i, w in enumerate(words)}
    shape = lambda w: p.classes + 1 + class_lm.shape(w.encode())
    pairs, n = Counter(), len(words)
    for t in texts:
        s = [0, *(rank.get(w, -shape(w)) for w in split(t)), 0]
        pairs.update(zip(s, s[1:]))
    near = {w: [(k, c) for k, c in pairs.items() if w in k] for w in range(1, n + 1)}
    of = {0: 0} | {w: min(w, p.classes) for w in range(1, n + 1)}
    cls = lambda s, of: of[s] if s >= 0 else -s

    def grid(of):
        g = Counter()
        for (a, b), c in pairs.items():
            g[cls(a, of), cls(b, of)] += c
        return g

    xlogx = lambda x: x * math.log(x) if x else 0.0

    def likelihood(g):
        left, right = Counter(), Counter()
        for (a, b), c in g.items():
            left[a] += c
            right[b] += c
        return math.fsum([xlogx(c) for c in g.values()] + [-xlogx(c) for c in left.values()] + [-xlogx(c) for c in right.values()])

    def batch(of, words):
        of, g = dict(of), grid(of)
        left, right = Counter(), Counter()
        for (a, b), c in g.items():
            left[a] += c
            right[b] += c
        for w in words:
            was, options = of[w], []
            change = Counter({})
            for (a, b), c in near[w]:
                change[cls(a, of), cls(b, of)] -= c
            for k in range(1, p.classes + 1):
                of[w], d = k, Counter(change)
                for (a, b), c in near[w]:
                    d[cls(a, of), cls(b, of)] += c
                dl, dr = Counter(), Counter()
                for (a, b), c in d.items():
                    dl[a] += c
                    dr[b] += c
                terms = [xlogx(g[x] + c) - xlogx(g[x]) for x, c in d.items() if c] + [xlogx(left[x]) - xlogx(left[x] + c) for x, c in dl.items() if c] + [xlogx(right[x]) - xlogx(right[x] + c) for x, c in dr.items() if c]
                options.append((math.fsum(terms), d, dl, dr))
            best = max(range(p.classes), key=lambda k: (round(options[k][0], 7), -k)) + 1
            best = best if options[best - 1][0] > options[was - 1][0] + 1e-8 else was
            _, d, dl, dr = options[best - 1]
            for total, add in ((g, d), (left, dl), (right, dr)):
                for x, c in add.items():
                    total[x] += c
            of[w] = best
        return of

    for _ in range(2):
        of = batch(of, range(1, min(n, p.lead) + 1))
    batches = -(-n // p.batch)
    for k in range(p.sweeps):
        moved = dict(of)
        for b in range(batches):
            own = [w for w in range(1, n + 1) if w % batches == b]
            done = batch(of, own)
            moved |= {w: done[w] for w in own}
        part, now = 1, likelihood(grid(of))
        while part <= batches:
            new = {w: moved[w] if w % batches % part == k % part else of[w] for w in of}
            if likelihood(grid(new)) > now:
                break
            part *= 2
        else:
            break
        of = new
        if likelihood(grid(of)) - now < p.settled * abs(now):
            break
    return {w: of[i + 1] for i, w in enumerate(words)}


def test_classes_match_brute_force_and_dont_depend_on_tasks(spark):
    p = class_lm.Params(classes=6, lead=40, batch=90, sweeps=3, settled=0.0001)
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id % 3 = 0")
    want = slow_classes([r["text"] for r in texts.collect()], p)
    assert len(want) > 300
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    scores = []
    try:
        for n in (1, 4, 9):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            rows = texts.repartition(n)
            model = class_lm.train(rows, params=p)
            assert model.classes == want
            scores.append({r["doc_id"]: r["score"] for r in class_lm.score(rows, model).collect()})
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert all(scores[0][i] == pytest.approx(s[i], rel=1e-12) for s in scores for i in s)


def test_every_language_with_a_letter_is_learned(spark):
    rows = [(1, "hello there and good morning to you all", "en"), (2, "你", "zh"), (3, "12 34", "xx"), (4, None, "yy"), (5, "a", "a"), (6, "words", None)]
    content = lang_zstd.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(content) == {"en", "zh", "a"}
    assert lang_zstd.Classifier(content, lang_zstd.Params())("你 你 你")[0] == "zh"


def test_languages_are_learned_from_texts_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    assert lang_zstd.train(docs) == lang_zstd.train(docs.select((F.col("doc_id") * 7919 + 5).alias("doc_id"), "text", "lang").repartition(3))


def test_predicted_languages_match_plain_compression(spark):
    """Spans cut and compressed anew, without prepared dictionaries or shared tools."""
    import zstandard

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    content, p = lang_zstd.train(docs.where("doc_id % 2 = 0")), lang_zstd.Params()
    wrong = 0
    for r in lang_zstd.classify(docs.where("doc_id % 7 = 3"), content).collect():
        letters = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (r["text"] or "").lower()).split()
        data = (" ".join(letters) + " ").encode() if letters else b""
        sizes = {}
        for lang, raw in content.items():
            n = -(-len(data) // p.span)
            step = -(-len(data) // n) if n else 1
            made = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            sizes[lang] = sum(len(zstandard.ZstdCompressor(level=p.level, dict_data=made, write_content_size=False, write_dict_id=False).compress(data[i : i + step])) for i in range(0, len(data), step))
        first, second = sorted((s, x) for x, s in sizes.items())[:2]
        got = r["language"]
        if not data:
            assert (got["lang_pred"], got["score"], got["rejected"]) == ("und", 0.0, True)
        else:
            margin = 1 - first[0] / second[0]
            wrong += got["lang_pred"] != first[1] or got["rejected"] != (margin < p.min_margin) or abs(got["score"] - margin) > 0.01
    assert wrong == 0
