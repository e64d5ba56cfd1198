"""Embedding near-duplicates, components and the pipeline against brute force."""

import numpy as np

from cellscape.llm import nn_descent
from cellscape.llm.graph import connected_components


def slow_links(rows, threshold=0.98):
    ids, vecs, labels = zip(*rows)
    unit = [nn_descent.unit(v, l) for v, l in zip(vecs, labels)]
    unit = [None if u is None else np.frombuffer(u) for u in unit]
    near = [[j for j in range(len(ids)) if j != i and unit[i] is not None and unit[j] is not None and labels[i] == labels[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(len(ids))]
    least = list(ids)
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            m = min([least[i], *(least[j] for j in near[i])])
            changed |= m != least[i]
            least[i] = m
    return {ids[i]: (len(near[i]), least[i]) for i in range(len(ids))}


def planted(seed=5):
    rng = np.random.default_rng(seed)
    out = []

    def add(v, label):
        out.append((len(out), None if v is None else [float(x) for x in np.float32(v)], label))

    for k in range(150):
        add(rng.standard_normal(16), k % 3)
    for _ in range(40):  # pairs at all distances near the threshold
        v = rng.standard_normal(16)
        add(v, 1)
        add(v + rng.standard_normal(16) * rng.choice([0.01, 0.1, 0.19, 0.2, 0.21]), 1)
    v = rng.standard_normal(16)
    for _ in range(400):  # more than a neighbour list or a block holds
        add(v + rng.standard_normal(16) * 0.01, 2)
    for _ in range(30):
        add(v, 2)
    for odd, label in ((None, 1), ([], 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([float("inf")] * 16, 2), ([1e300] * 16, 0), ([1e-300] * 16, 0), (v, None), ([1.0], 1)):
        out.append((len(out), None if odd is None else [float(x) for x in odd], label))
    return out


def test_links_and_components_match_brute_force(spark):
    rows = planted()
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<double>, label int, id int, n int, key string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nn_descent.near_duplicates(df).collect()}
    assert got == slow_links(rows)


def test_empty_and_null_components(spark):
    df = spark.createDataFrame([(1, [1.0, None], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in nn_descent.near_duplicates(df).collect()}
    assert got == {1: (0, 1, True), 2: (1, 2, True), 3: (1, 2, False)}
    assert nn_descent.near_duplicates(df.limit(0)).count() == 0


def test_audited_recall(spark):
    rows = [r for r in planted(8) if r[1] and r[2] is not None and np.isfinite(r[1]).all() and any(r[1]) and len(r[1]) == 16]
    nodes = spark.createDataFrame([(i, str(l), bytearray(nn_descent.unit(v, l))) for i, v, l in rows], "id long, label string, vec binary")
    params = nn_descent.Params()
    lists = nn_descent.neighbour_graph(nodes, params)
    found = nn_descent.audit(nodes, lists, params)
    assert found.asked[0] and found.recall >= 0.95


def test_repeated_and_null_ids_and_text_labels(spark):
    rows = [(1, [0.0, 1.0], "a"), (1, [1.0, 0.0], "a"), (2, [1.0, 0.01], "a"), (None, [0.01, 1.0], "a"), (None, [1.0, 0.0], "a"), (3, [1.0, 0.0], "b"), (None, [1.0, 1.0], "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in nn_descent.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, 1), (1, 2, 1), (2, 2, 1), (None, 1, 1), (None, 2, 1), (3, 0, 3), (None, 0, None)], key=str)


def test_chain_of_three_wide_groups(spark):
    """Links between neighbouring groups only; blocks and bins of many nodes, none of whose pairs is told by an angle alone."""
    rng = np.random.default_rng(6)
    e = np.eye(48)
    rows = []
    for k in range(3):
        angle = 0.16 * k
        centre = np.cos(angle) * e[0] + np.sin(angle) * e[1]
        for _ in range(150):
            rows.append((len(rows), [float(x) for x in centre + rng.standard_normal(48) * 0.008], 1))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nn_descent.near_duplicates(df, params=nn_descent.Params(block=40)).collect()}
    assert got == slow_links(rows)


def test_tight_groups_that_fill_their_lists_are_joined(spark):
    rng = np.random.default_rng(3)
    a = rng.standard_normal(64)
    a /= np.linalg.norm(a)
    side = rng.standard_normal(64)
    side -= a * (side @ a)
    side /= np.linalg.norm(side)
    rows = []
    for centre in (a, 0.987 * a + np.sqrt(1 - 0.987**2) * side):
        rows += [(len(rows) + k, [float(x) for x in centre + rng.standard_normal(64) * 0.0025], 1) for k in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nn_descent.near_duplicates(df).collect()}
    assert got == slow_links(rows) and {c for _, c in got.values()} == {0} and min(n for n, _ in got.values()) > 99


def test_audit_weighs_queries_alike(spark):
    rng = np.random.default_rng(4)
    rows = []
    big = rng.standard_normal(32)
    for _ in range(300):
        rows.append((len(rows), big + rng.standard_normal(32) * 0.01))
    for _ in range(50):
        v = rng.standard_normal(32)
        rows += [(len(rows), v), (len(rows) + 1, v + rng.standard_normal(32) * 0.05)]
    nodes = spark.createDataFrame([(i, "1", bytearray(nn_descent.unit(v, 1))) for i, v in rows], "id long, label string, vec binary")
    member = spark.createDataFrame([(i, 0) for i in range(300)], "node long, component long")  # every pair is missed
    found = nn_descent.audit(nodes, member, nn_descent.Params())
    assert found.asked[0] > 30 and found.found[0] == 0 and found.recall < 1
    assert nn_descent.tables_for(20, nn_descent.Params()) > nn_descent.tables_for(12, nn_descent.Params()) >= 8


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (7, 7)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    assert connected_components(df.limit(0)).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline
    from cellscape.llm.common import table

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = table(stage(spark, docs, sf), name)
        kept.append((name, docs.count(), docs.select("doc_id").distinct().count()))
        if name != "token_output":
            assert docs.columns == columns
    rows = [k[1] for k in kept]
    assert 200 >= rows[0] >= 190 and rows[0] >= rows[1] >= rows[2] > 0 and rows[3] == rows[4]
    assert corpus_pipeline.run(spark, sf).count() == rows[4]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def stages(spark, rows, sf="/root/testdata/sf0.001"):
    """The written result of every stage but the last."""
    import corpus_pipeline
    from cellscape.llm.common import table

    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = table(stage(spark, docs, sf), name)
        yield name, docs


def slow_mix(rows):
    """How often each row (id, text, source) comes: passes over its source, and the last one where at least half of it is needed."""
    import hashlib
    import re

    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), k) for k, (i, t, s) in enumerate(rows)]
    names = sorted({s for _, s, _, _ in sized}, key=lambda s: (s is None, s or ""))
    words = {s: sum(n for _, x, n, _ in sized if x == s) for s in names}
    weight, target, open_, left = {s: k % 3 + 1 for k, s in enumerate(names)}, {}, list(names), sum(words.values())
    while open_:  # whoever would pass three times its size stops there, the rest goes to the others
        line = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if 3 * words[s] < line * weight[s]]
        for s in full or open_:
            target[s] = float(3 * words[s]) if full else line * weight[s]
        left -= sum(target[s] for s in full)
        open_ = [s for s in open_ if s not in target]
    out = []
    for s in names:
        quota, start = round(target[s]), 0
        own = sorted((x for x in sized if x[1] == s), key=lambda x: (hashlib.md5(str(x[0]).encode()).hexdigest(), x[0] or 0, x[2]))
        for _, _, n, k in own:
            passes = quota // words[s] if words[s] else 0
            rest = max(0, min(n, quota - passes * words[s] - start))
            out += [k] * (passes + (n > 0 and 2 * rest >= n) if passes * n + rest > 0 else 0)
            start += n
    return sorted(out)


def whole_encodings(rows):
    """(doc_id, n_tokens, crc32) of each row by the library's encoding of whole texts."""
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for i, t in rows:
        ids = [*tool.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return sorted(out, key=str)


def told(spark, docs):
    """Rows that language identification doesn't reject, by the classifier on each text alone."""
    from pyspark.sql import functions as F

    from cellscape.llm import lang_zstd
    from cellscape.llm.common import crc_bucket

    tool = lang_zstd.Classifier(lang_zstd.train(docs.where(crc_bucket(F.col("doc_id"), 3) != 1)), lang_zstd.Params())
    return [r for r in docs.collect() if not tool(r["text"])[2]]


def test_pipeline_odd_rows(spark):
    odd = [(1, None, None, None, None), (None, "the word and more words are here", "en", None, 1), (2, "", "en", "a", 0), (3, "more words are here and the word", "en", "a", 1), (3, "more words are here and the word", "en", "a", 1), (8, "ein ganz anderer Satz mit Wörtern", "de", "b", 1), (9, "12 34", "de", "b", 1)]
    assert [docs.count() for _, docs in stages(spark, [])] == [0] * 5
    frames = dict(stages(spark, odd))
    rows = {name: sorted(map(tuple, docs.collect()), key=str) for name, docs in frames.items()}
    kept = told(spark, spark.createDataFrame(odd, SCHEMA))
    assert rows["language_id"] == sorted(map(tuple, kept), key=str) and len(kept) == 4
    assert rows["simhash_near_dedup"] == sorted(set(map(tuple, kept)), key=str) == rows["decontamination"]
    left = rows["decontamination"]
    assert rows["mixing"] == sorted((left[k] for k in slow_mix([(r[0], r[1], r[3]) for r in left])), key=str)
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in frames["token_output"].collect()), key=str)
    assert got == whole_encodings([(r[0], r[1]) for r in rows["mixing"]])


def test_pipeline_language_mixing_and_tokens_match_brute_force(spark):
    """On the whole small table with repeated ids and rows, each stage's rows exactly."""
    import corpus_pipeline
    from cellscape.llm.common import table

    sf = "/root/testdata/sf0.001"
    given = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = given + given[:15] + [(r[0], r[1], r[2], None, r[4]) for r in given[15:25]] + [(10_000 + i, t, "en", "z", 1) for i, t in enumerate((None, "", "4711 !?", "\n \t"))]
    docs = table(spark.createDataFrame(rows, SCHEMA), "given")
    kept = corpus_pipeline.language(spark, docs, sf).collect()
    assert sorted(map(tuple, kept), key=str) == sorted(map(tuple, told(spark, docs)), key=str) and len(kept) > 0.9 * len(given)
    mix = table(corpus_pipeline.mixture(spark, docs, sf), "mix")
    want = [rows[k] for k in slow_mix([(r[0], r[1], r[3]) for r in rows])]
    assert sorted(map(tuple, mix.collect()), key=str) == sorted(want, key=str) and len(want) > len(rows)
    out = table(corpus_pipeline.token_output(spark, mix, sf), "tokens").collect()
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out), key=str) == whole_encodings([(r[0], r[1]) for r in want])
    starts = sorted((r["start"], r["n_tokens"]) for r in out)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_pipeline_with_clashing_columns(spark):
    import corpus_pipeline
    from cellscape.llm.common import table

    extra = ["language", "row_file", "row_place", "gone_row_file", "mix_id", "mix_due", "doc", "kept", "row", "id", "fp", "mix"]
    docs = spark.createDataFrame([(1, "the words of this text are here", "en", "a", 1), (1, "andere worte in einem text", "de", "b", 2)], SCHEMA).selectExpr("*", *[f"'{c}' AS {c}" for c in extra])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "language_id":
            continue
        columns = docs.columns
        docs = table(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert docs.columns == columns and {tuple(r[c] for c in extra) for r in docs.collect()} == {tuple(extra)}
    assert docs.select("text").distinct().count() == 2


def test_pipeline_stages_match_brute_force_by_rows(spark):
    """Repeated and null ids lose no text of their own and keep no copy; leaks of rows without an id go."""
    import re

    import corpus_pipeline
    from cellscape.llm import simhash
    from cellscape.llm.common import table

    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [tuple(r) for r in given]
    for r in rows[:20]:
        rows += [(r[0], *r[1:]), (None, *r[1:])]  # the same row again, and without its id
    for i, item in enumerate(items[:10]):
        rows.append((None if i % 2 else 5, f"{rows[i][1]} {item}", "en", "z", 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = [tuple(r) for r in table(corpus_pipeline.near_duplicates(spark, docs, sf), "kept").collect()]
    prints = {t: simhash.fingerprint(t) for t in {r[1] for r in rows}}
    group = dict(zip(sorted(set(prints.values())), range(len(rows))))
    changed = True
    while changed:
        changed = False
        for a in group:
            for b in group:
                if bin(a ^ b).count("1") <= 2 and group[b] < group[a]:
                    group[a], changed = group[b], True
    first = {}
    for r in rows:
        g = group[prints[r[1]]]
        first[g] = min(first.get(g, (True, 0)), (r[0] is None, r[0] or 0))
    assert sorted((group[prints[r[1]]], (r[0] is None, r[0] or 0)) for r in kept) == sorted(first.items())

    def shingles(t):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    known = [shingles(t) for t in items]
    clean = [tuple(r) for r in table(corpus_pipeline.decontamination(spark, docs, sf), "clean").collect()]
    want = [r for r in rows if not any(len(s & shingles(r[1])) >= 0.8 * len(s) for s in known)]
    assert sorted(clean, key=str) == sorted(want, key=str) and len(want) < len(rows)


def test_recall_of_rare_links_is_measured(spark):
    """Forty pairs among nine thousand vectors: queries are drawn from what is tied, and the rest stands for all others."""
    rng = np.random.default_rng(12)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((8920, 24)))]
    for _ in range(40):
        v = rng.standard_normal(24)
        rows += [(len(rows), v), (len(rows) + 1, v + rng.standard_normal(24) * 0.02)]
    nodes = spark.createDataFrame([(i, "1", bytearray(nn_descent.unit(v, 1))) for i, v in rows], "id long, label string, vec binary")
    member = nn_descent.neighbour_graph(nodes, nn_descent.Params())
    found = nn_descent.audit(nodes, member, nn_descent.Params())
    assert found.asked[0] >= 80 and found.recall == 1.0 and member.select("component").distinct().count() == 40
    half = member.where(member["component"].isin([r["component"] for r in member.select("component").distinct().orderBy("component").limit(20).collect()]))
    told = nn_descent.audit(nodes, half, nn_descent.Params())
    assert abs(told.recall - 0.5) < 0.15 and not told.reaches(0.99)  # the others stand for links that nothing ties


def test_what_is_found_is_kept_where_draws_run_out(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(nn_descent, "audit", lambda *_: nn_descent.Audit((40.0, 0.0), (80.0, 0.0), (80, 0)))
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(60):
        v = rng.standard_normal(24)
        rows += [(len(rows), v), (len(rows) + 1, v + rng.standard_normal(24) * 0.02)]
    nodes = spark.createDataFrame([(i, "1", bytearray(nn_descent.unit(v, 1))) for i, v in rows], "id long, label string, vec binary")
    with pytest.warns(UserWarning, match="after 1 draws"):
        member = nn_descent.neighbour_graph(nodes, nn_descent.Params(most_draws=1))
    assert member.count() > 60
