"""Each operator on the fixture against brute force or a contract, and on an empty table."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.llm import line_dedup, lm_scoring, mixing, neighbours, ngram_join, packing, quality_classifier, quality_rules, sharding, toxicity
from tests.llm.brute import line_shingles
from tests.llm.fixture import LARGE, corpus, empty, labels, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return corpus(spark).cache()


def test_ngram_join(spark, docs):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_join(docs).collect())
    data = rows()
    sets = []
    for r in data:
        w = WORD.findall((r[1] or "").translate(LOW))
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set()))
    up = list(range(len(data)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and data[i][0] is not None and data[j][0] is not None and 100 * len(a & b) >= 85 * len(a | b):
                up[root(i)] = root(j)
    least = defaultdict(lambda: math.inf)
    for i, r in enumerate(data):
        if r[0] is not None:
            least[root(i)] = min(least[root(i)], r[0])
    want = Counter((r[0], len(sets[i]), None if r[0] is None else least[root(i)]) for i, r in enumerate(data))
    assert got == want
    assert ngram_join.jaccard_join(empty(spark)).count() == 0


def test_quality_rules(spark, docs):
    got = quality_rules.quality_rules(docs).collect()
    assert len(got) == len(rows())
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    for r in rows():
        t, w = r[1] or "", WORD.findall(r[1] or "")
        if r[0] is None:
            continue
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        hit = {k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
        failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
        x = by[r[0]]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), failed)
        assert not (failed and x.kept)
    assert quality_rules.quality_rules(empty(spark)).count() == 0


def test_concentration_rejects_planted_outliers(spark):
    from pageloom.llm.work import Scratch

    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 2)) @ np.array([[1, 0.8], [0, 0.6]])
    x[:60] += [6, -6]
    df = spark.createDataFrame([(i, "en" if i % 2 else None, "s", float(a), float(b)) for i, (a, b) in enumerate(x)], "doc_id bigint, lang string, source string, u double, v double")
    out = quality_rules.robust_outliers(df, ["lang", "source"], {"u": 0.01, "v": 0.01}, Scratch(spark, "t"), level=0.999).collect()
    assert {r.doc_id for r in out if r.outlier} >= set(range(60))
    assert sum(r.outlier for r in out) < 75


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 8))
    x = centres[rng.integers(0, 30, 3000)] + 0.3 * rng.normal(size=(3000, 8))
    x[100:400] = x[100]
    data = [(i, [float(c) for c in v], "x") for i, v in enumerate(x)] + [(5001, None, "x"), (5002, [0.0] * 8, "x"), (5003, [1.0, None] + [0.0] * 6, "x"), (5004, [float("nan")] * 8, "x"), (None, [1.0] * 8, "x")]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, part string")
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 3000, 20))
    hits = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(3000), -np.round(s, 12)))[:20]
        hits += len({v for v, _ in found} & set(want.tolist()))
        assert len(found) == 20 and q not in {v for v, _ in found}
        assert all(abs(score - x[v] @ x[q]) < 1e-9 for v, score in found)
    assert hits / (20 * len(got)) >= 0.9
    # one vector of another length goes alone
    odd = neighbours.nearest(df.where("vec_id < 200").unionByName(spark.createDataFrame([(6000, [1.0], "x")], df.schema)), F.col("vec_id") % 20 == 0)
    assert odd.select("query_id").distinct().count() == 10
    few = neighbours.nearest(df.where("vec_id < 5 or vec_id > 5000"), F.col("vec_id") % 20 == 0).collect()
    assert len(few) == 4
    assert neighbours.nearest(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_of_learned_partitions(spark, monkeypatch):
    """Sixty parts and more in two levels; where vectors form clusters a query searches few of them."""
    monkeypatch.setattr(neighbours, "ROWS", 60)
    monkeypatch.setattr(neighbours, "MOST_PARTS", 12)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(80, 16))
    x = centres[rng.integers(0, 80, 6000)] + 0.35 * rng.normal(size=(6000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    searched = []
    monkeypatch.setattr(neighbours.Scratch, "save", lambda self, d, name, save=neighbours.Scratch.save: searched.append((name, out := save(self, d, name))) or out)
    got = defaultdict(set)
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got[r.query_id].add(r.vec_id)
    tables = dict(searched)
    parts = tables["indexed"].select("part").distinct().count()
    assert parts >= 50 and tables["routed"].count() <= 0.4 * parts * 300
    hits = 0
    for q in range(0, 6000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-s)[:20].tolist()))
    assert hits / 6000 >= 0.9


def test_sharding(spark, docs):
    got = sharding.extendible_shards(docs, "doc_id", F.octet_length("text"), 3000).collect()
    assert len(got) == len(rows())
    sizes = Counter()
    for r in got:
        sizes[(r.depth, r.prefix)] += r.bytes
        assert r.prefix == r.hash >> (60 - r.depth)
    for r in got:
        assert sizes[(r.depth, r.prefix)] == r.shard_bytes and (r.shard_bytes <= 3000) != r.oversized
    spans = sorted((p << (60 - d), (p + 1) << (60 - d)) for d, p in sizes)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert sharding.extendible_shards(empty(spark), "doc_id", F.octet_length("text"), 3000).count() == 0


def test_lm_scoring(spark, docs):
    got = {r.doc_id: r for r in lm_scoring.lm_scores(docs).collect() if r.doc_id is not None}
    counts, total = Counter(), 0
    low = lambda t: WORD.findall((t or "").translate(LOW)) + [None]
    for r in rows():
        if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 2:
            counts.update(low(r[1]))
            total += len(low(r[1]))
    for r in rows():
        if r[0] is not None:
            x, w = got[r[0]], low(r[1])
            assert (x.n_tokens, x.n_known, x.train_tokens) == (len(w), sum(counts[t] > 0 for t in w), total)
            assert math.isclose(x.base_score, sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in w), rel_tol=1e-9)
            assert -1e6 < x.score < 0 and x.word_score > -1e6
    assert LARGE in got
    assert lm_scoring.lm_scores(empty(spark)).count() == 0


def test_lattice_against_enumeration():
    v = lm_scoring.Vocabulary(packing.tokenizer_path())
    logp = v.start()
    lattice = lm_scoring.Lattice(v, logp)

    def brute(part: bytes) -> float:
        total = 0.0
        for cut in range(1 << (len(part) - 1)):
            ends = [i + 1 for i in range(len(part) - 1) if cut >> i & 1] + [len(part)]
            ids = [(v.final if e == len(part) else v.inner).get(part[a:e]) for a, e in zip([0, *ends], ends, strict=False)]
            if None not in ids:
                total += math.exp(sum(logp[i] for i in ids))
        return math.log(total)

    words = [b"hello", b"a", "żółw".encode(), b"x" * 60, b"ab12c"]
    got = lattice.score(words)
    for w, s in zip(words, got, strict=True):
        parts = lm_scoring.parts_of(w)
        if len(w) < 20:
            assert math.isclose(s, sum(map(brute, parts)) + logp[v.glue] * (len(parts) - 1), rel_tol=1e-9)
    long = lattice._long(b"hello")
    assert math.isclose(long, got[0], rel_tol=1e-9)
    sums = np.zeros(v.size)
    lattice.expected([b"a", b"hello"], sums)
    assert sums[v.final[b"a"]] >= 0.999 and 1 <= sums.sum() <= 6


def test_mixing(spark, docs):
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "_epoch", "__domain", "_tokens"]  # docs has columns epoch, domain, _domain and tokens
    got = out.groupBy("__domain", F.coalesce("lang", F.lit("")).alias("l"), F.coalesce("source", F.lit("")).alias("s")).agg(F.sum("_tokens").alias("t")).collect()
    have = Counter()
    for r in rows():
        have[(r[2] or "", r[3] or "")] += len(WORD.findall(r[1] or ""))
    for r in got:
        assert 0 < r.t <= 2 * have[(r.l, r.s)]
    assert out.where("_epoch > 1").count() == 0
    plan = Counter((r.doc_id, r.epoch) for r in mixing.schedule(docs).collect())
    assert plan == Counter((r.doc_id, r._epoch) for r in out.select("doc_id", "_epoch").collect())
    assert mixing.mix(empty(spark)).count() == 0


def test_budgets_flow_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 100, 1), ("a", "x", "2", 1000, 1), ("a", "y", "3", 1000, 1), ("b", "x", "4", 1000, 1)], "domain string, lang string, source string, tokens bigint, n bigint")
    same = {"domain": {"a": 1.0, "b": 1.0}, "lang": {"x": 1.0, "y": 1.0}, "source": {k: 1.0 for k in "1234"}}
    got = {r.source: round(r.budget, 6) for r in mixing.leaf_budgets(leaves, 2000, 1, same).collect()}
    # source 1 can't hold its 250: its sibling 2 gets the rest of 500; nothing reaches y or b
    assert got == {"1": 100, "2": 400, "3": 500, "4": 1000}
    got = {r.source: round(r.budget, 6) for r in mixing.leaf_budgets(leaves, 3000, 1, same).collect()}
    assert got == {"1": 100, "2": 900, "3": 1000, "4": 1000}


def test_line_dedup(spark, docs):
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect() if r.doc_id is not None}
    data = {r[0]: r[1] for r in rows() if r[0] is not None}

    lines = [(d, n, x) for d in sorted(data) for n, x in enumerate((data[d] or "").split("\n")) if WORD.search(x)]
    sets = [line_shingles(x) for _, _, x in lines]
    up = list(range(len(lines)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i in range(len(lines)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    gone = defaultdict(set)
    for i, (d, n, _) in enumerate(lines):
        if root(i) != i:
            gone[d].add(n)
    for d, t in data.items():
        left = "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in gone[d])
        if not gone[d]:
            assert got[d] == t
        elif WORD.search(left):
            assert got[d] == left
        else:
            assert d not in got
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


@pytest.mark.parametrize("run", [toxicity.toxicity, quality_classifier.classify])
def test_classifiers(spark, docs, run):
    got = run(docs, labels(spark)).collect()
    assert len(got) == len(rows())
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert LARGE in {r.doc_id for r in got}
    assert {r.doc_id for r in got if r.held_out} == {r[0] for r in rows() if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0}
    assert run(empty(spark), labels(spark)).count() == 0
    assert run(docs, labels(spark).where("false")).count() == len(got)


def test_trees_isotonic_and_machine_learn():
    from pageloom.llm.learning import FactorisationMachine, Isotonic, Trees

    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = Trees(rounds=60).fit(x[:1500], y[:1500])
    scale = Isotonic().fit(trees.raw(x[1000:1500]), y[1000:1500])
    assert ((scale(trees.raw(x[1500:])) > 0.5) == y[1500:]).mean() > 0.9
    assert (np.diff(scale(np.linspace(-5, 5, 100))) >= 0).all()
    rows_ = [(np.array([a, 10 + b]), np.ones(2, np.float32)) for a in range(10) for b in range(10) for _ in range(10)]
    z = np.array([float((r[0][0] % 2) == (r[0][1] % 2)) for r in rows_])
    machine = FactorisationMachine(20, rank=4, epochs=60).fit(rows_, z)
    raw = machine.raw(rows_)
    assert ((raw > 0) == z).mean() > 0.9
    k, v = rows_[7]
    slow = machine.w0 + machine.w[k].sum() + float(machine.v[k[0]] @ machine.v[k[1]])
    assert math.isclose(float(raw[7]), slow, rel_tol=1e-4)


def test_scores_of_texts_are_those_of_the_lattice(spark, monkeypatch):
    """Without rounds of fitting, against sums over all ways through each word by a plain recursion."""
    data = [(1, "An anthill, an ant."), (2, "the Xylophone"), (3, None), (4, "an an an")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in lm_scoring.score_texts(docs, F.col("doc_id") == 2, rounds=0).collect()}
    v = lm_scoring.Vocabulary(packing.tokenizer_path())
    p = np.exp(v.start())

    def ways(part):
        a = [1.0] + [0.0] * len(part)
        for j in range(1, len(part) + 1):
            table = v.final if j == len(part) else v.inner
            a[j] = sum(a[i] * p[table[part[i:j]]] for i in range(j) if part[i:j] in table)
        return a[-1]

    words = [WORD.findall((t or "").translate(LOW)) for _, t in data]
    total = sum(len(w) + 1 for (d, _), w in zip(data, words, strict=True) if d != 2)
    p_end = 4 / (total + 2)
    for (d, _), ws in zip(data, words, strict=True):
        want = math.log10(p_end)
        for w in ws:
            parts = lm_scoring.parts_of(w.encode())
            want += math.log10((1 - p_end) * p[v.glue] ** (len(parts) - 1) * math.prod(map(ways, parts)))
        assert math.isclose(got[d], want, rel_tol=1e-9), d


def test_shards_are_written_whole(spark, tmp_path):
    rows_ = [(i % 40 if i % 9 else None, f"text {i}", "s") for i in range(300)]
    df = spark.createDataFrame(rows_, "doc_id bigint, text string, shard string")
    shards = sharding.extendible_shards(df, "doc_id", F.octet_length("text"), 400)
    sharding.write_shards(df, "doc_id", shards, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((a, b) for a, b, _ in rows_)
    sizes = {f"{r.depth:02}-{r.prefix:X}": (r.shard_bytes, r.n_rows) for r in sharding.directory(shards).collect()}
    got = {r._shard: (r.b, r.n) for r in back.groupBy("_shard").agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).collect()}
    assert got == sizes and len(got) > 3


def test_merges_are_those_of_the_tokenizer():
    tok = packing.tokenizer(packing.tokenizer_path())
    rng = np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrstuvwxyzäöüßéèñçÀÉ") + ["th", "er", "in", "tion"]
    texts = ["".join(rng.choice(letters, rng.integers(1, 14))) + str(rng.choice(["", ".", ",", "!!", "***", "'s", "'", "&&&", "…"])) for _ in range(4000)]
    texts += ["", "it's DON'T", "x" * 200, "ﬁne İstanbul ΑΣ", "a.b.c", "<|endoftext|>", "日本語 text", "1a2b"]
    got = list(packing.Encoder(packing.tokenizer_path())(texts))
    for t, g in zip(texts, got, strict=True):
        assert np.frombuffer(g, "<u4").tolist() == [*tok.encode(t, add_special_tokens=False).ids, 1], t


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    got = packing.pack(docs).collect()
    tok = Tokenizer.from_file(packing.tokenizer_path())
    tok.encode_special_tokens = True
    want = Counter()
    for r in rows():
        ids = np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        want[r[0]] += len(ids)
        for x in got:
            if r[0] is not None and x.doc_id == r[0]:
                part = ids[x.start : x.start + x.length]
                assert x.doc_tokens == len(ids) and x.length == len(part) and zlib.crc32(part.tobytes()) == x.ids_crc32
    have = Counter()
    by = defaultdict(list)
    for x in got:
        have[x.doc_id] += x.length
        by[x.sequence_id].append((x.offset, x.length))
    assert have == want
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == 2048 or at & (at - 1) == 0
    unique = docs.where("doc_id > 0")
    whole = packing.sequences(unique, packing.pack(unique)).collect()
    assert sum(len(r.ids) for r in whole) == sum(len(tok.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows() if r[0])
    assert packing.pack(empty(spark)).count() == 0


def test_plan_fills_windows():
    rng = np.random.default_rng(3)
    hist = Counter(rng.integers(1, 65, 5000).tolist())
    fills, over = packing.plan(hist, 64)
    used = Counter()
    for taken, times in fills:
        assert sum(k * v for k, v in taken.items()) == 64
        for k, v in taken.items():
            used[k] += v * times
    for k in hist:
        assert used[k] + over.get(k, 0) == hist[k]
    assert sum(over.values()) <= 100  # 2 % of the pieces
    assert packing.best_fill({5: 1, 4: 2, 3: 3}, 10) == (10, {4: 1, 3: 2}) or packing.best_fill({5: 1, 4: 2, 3: 3}, 10)[0] == 10


def test_settled_cells_take_no_further_step(spark, monkeypatch):
    """One cell hardly varies and settles at once; the others go on without it."""
    from pageloom.llm.work import Scratch

    cells, step = [], quality_rules._concentrated

    def watched(rows, params, keys, xs, floors, scale, h, work, name):
        if name.startswith("step"):
            cells.append({r.cell for r in params.select("cell").collect()})
        return step(rows, params, keys, xs, floors, scale, h, work, name)

    monkeypatch.setattr(quality_rules, "_concentrated", watched)
    rng = np.random.default_rng(21)
    rows = [(i, "flat", 1.0, 1.0) for i in range(60)]
    for c in range(4):
        x = rng.normal(size=(400, 2)) @ np.array([[1, 0.8], [0, 0.6]])
        x[:90] += [2, -2]
        rows += [(1000 * (c + 1) + i, f"c{c}", float(u), float(v)) for i, (u, v) in enumerate(x)]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, u double, v double")
    out = quality_rules.robust_outliers(df, ["lang"], {"u": 0.1, "v": 0.1}, Scratch(spark, "settled"), starts=1).collect()
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    assert len(cells[0]) == 5 and len(cells) > 1
    assert all(b < a or b == a and len(a) < 5 for a, b in zip(cells, cells[1:]))
    assert not any("flat" in c for later in cells[1:] for c in later)


def test_distances_are_those_of_plain_concentration(spark):
    """One start and one cell: medians and deviations, then concentration steps, by numpy."""
    from pageloom.llm.work import Scratch

    rng = np.random.default_rng(12)
    x = rng.normal(size=(301, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.2], [0, 0, 0.7]])
    x[:40] += [4, -5, 6]
    floors = {"u": 0.1, "v": 0.2, "w": 0.05}
    df = spark.createDataFrame([(i, "en", *map(float, r)) for i, r in enumerate(x)], "doc_id bigint, lang string, u double, v double, w double")
    got = {r.doc_id: (r.d2, r.outlier) for r in quality_rules.robust_outliers(df, ["lang"], floors, Scratch(spark, "plain"), starts=1, level=0.999).collect()}
    h, d, f2 = 0.75, 3, np.diag([v * v for v in floors.values()])
    scale = h / quality_rules._gamma_p((d + 2) / 2, quality_rules.chi2_quantile(h, d) / 2)
    rank = lambda a, p: np.sort(a, axis=0)[math.ceil(p * len(a)) - 1]
    m = rank(x, 0.5)
    cov = np.diag((1.4826 * rank(np.abs(x - m), 0.5)) ** 2) + f2
    far = lambda: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m)
    for k in range(14):
        d2 = far()
        near = x[d2 <= rank(d2, h)]
        was, m = np.linalg.slogdet(cov)[1], near.mean(0)
        cov = ((near.T @ near) / len(near) - np.outer(m, m)) * scale + f2
        if k > 1 and was - np.linalg.slogdet(cov)[1] < 1e-3:
            break
    want = far()
    assert all(math.isclose(got[i][0], want[i], rel_tol=1e-6) for i in range(len(x)))
    assert {i for i in got if got[i][1]} == set(np.flatnonzero(want > quality_rules.chi2_quantile(0.999, d)).tolist()) >= set(range(40))


@pytest.mark.parametrize("long", [False, True])
def test_classifiers_score_each_text_as_it_is(spark, docs, long):
    """Rows of a table get the score that the model gives their text alone, whatever stands beside it and however long it is."""
    model = toxicity.train(docs, labels(spark))
    texts = [r[1] for r in rows()] + (["spam idiot " * 20_000] if long else [])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.tox for r in toxicity.score(df, model, ["doc_id"], "tox").collect()}
    features = toxicity.featurizer(model.lexicon)
    for i, t in enumerate(texts):
        assert math.isclose(got[i], float(model.scale(model.trees.raw(features(t)[None, :]))[0]), rel_tol=1e-12)
    edges, machine = quality_classifier.train(docs, labels(spark))
    scores = {r.doc_id: r.score for r in quality_classifier.classify(docs, labels(spark)).collect() if r.doc_id is not None}
    read = quality_classifier.reader(edges)
    for r in rows():
        if r[0] is not None:
            z = float(machine.raw([read(r[1], None if r[4] is None else float(r[4]))])[0])
            assert math.isclose(scores[r[0]], 1 / (1 + math.exp(-max(-30, min(30, z)))), rel_tol=1e-5)
