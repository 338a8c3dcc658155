"""Whitening, hard-negative mining and personal data against plain computations."""

import hashlib
import math
import random
import re
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import hard_negatives, personal_data, queries, whitening

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, v array<int>, x string, id string, q int, n long"
INF, NAN = float("inf"), float("nan")


def vector_rows(n=300, dims=12, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dims))
    rows = []
    for i in range(n):
        e = centers[i % 6] + 0.3 * rng.normal(size=dims)
        rows.append((i, [float(np.float32(c)) for c in e], int(i % 4), None, "x", None, 1, None))
    rows += [(5, *rows[5][1:]), (300, rows[7][1], 2, [1], "x", "i", 1, 1), (301, rows[7][1], 2, None, None, None, None, None)]
    rows += [(400, None, 1, None, None, None, None, None), (401, [None] + rows[0][1][1:], 1, None, None, None, None, None)]
    rows += [(402, [INF] + rows[0][1][1:], 1, None, None, None, None, None), (403, [NAN] * dims, 1, None, None, None, None, None)]
    rows += [(404, [0.5, 1.0], 1, None, None, None, None, None), (405, [], 1, None, None, None, None, None)]
    rows += [(None, rows[3][1], 3, None, None, None, None, None), (500, rows[8][1], None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(vector_rows(), VECTORS)


def exact(vecs):
    return np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vecs], object)


def check_whitening(rows, vecs):
    x = exact(vecs)
    n, s = len(x), x.sum(axis=0)
    d = x * n - s
    centred = d.astype(float) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:8], basis[:, ::-1][:, :8]
    want = centred @ (basis / np.sqrt(values))
    assert Counter((r.vec_id, r.component) for r in rows) == Counter(
        (i, k + 1) for i, _ in vecs_ids(vecs) for k in range(len(values))
    )
    by_vec = {}
    for r in rows:
        by_vec.setdefault(r.vec_id, {}).setdefault(r.component, r)
    got = np.array([[by_vec[i][k + 1].whitened for k in range(len(values))] for i, _ in vecs_ids(vecs)])
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * sign).max() < 1e-8
    for (i, _), row in zip(vecs_ids(vecs), d):
        assert int(by_vec[i][1].deviation) == sum(int(v) ** 2 for v in row)
    assert {r.n for r in rows} == {n}
    assert max(r.identity_error for r in rows) < 1e-9
    for k in range(len(values)):
        assert by_vec[rows[0].vec_id][k + 1].explained == pytest.approx(values[k] / np.trace(centred.T @ centred / n), rel=1e-9)


_IDS = {}


def vecs_ids(vecs):
    return [(_IDS[id(v)], v) for v in vecs]


def test_whitening_of_the_table_and_of_awkward_rows(spark, vectors):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").limit(120).collect()
    for df, chosen in (
        (spark.createDataFrame(table), [(r.vec_id, r.embedding) for r in table]),
        (vectors, [(r[0], r[1]) for r in vector_rows() if r[1] and len(r[1]) == 12 and all(c is not None and math.isfinite(c) for c in r[1])]),
    ):
        vecs = [list(v) for _, v in chosen]
        _IDS.clear()
        _IDS.update({id(v): i for (i, _), v in zip(chosen, vecs)})
        check_whitening(whitening.whiten(df).collect(), vecs)


def test_bit_planes_count_exact_products():
    rng = np.random.default_rng(3)
    for rows, high in ((1, 5), (63, 1), (64, 1000), (200, 1 << 40), (130, 1 << 53)):
        x = rng.integers(0, high, (rows, 5))
        x[:, 2] = 0  # a dimension without a plane
        bits = np.array([int(m).bit_length() for m in x.max(axis=0)])
        full = np.column_stack([x, np.ones(rows, np.int64)]).astype(object)
        assert (whitening.cross_products(x, bits) == np.triu(full.T @ full)).all()


def test_whitening_without_spread_or_rows(spark, vectors):
    assert whitening.whiten(vectors.limit(0)).collect() == []
    assert whitening.whiten(vectors.where("embedding is null")).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 2.0])] * 3, "vec_id long, embedding array<float>")).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained) for r in one] == [(1, 3, 0, None, 0.0), (2, 3, 0, None, 0.0)] * 3
    wide = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 7.0])]
    rows = whitening.whiten(spark.createDataFrame(wide, "vec_id long, embedding array<float>")).collect()
    assert len(rows) == 6 and all(math.isfinite(r.whitened) for r in rows if r.whitened is not None)
    x = [[2**52 + 100_000, 100_000], [-(2**52) + 100_000, 101_024], [100_000, 107_168]]
    s = [sum(c) for c in zip(*x)]
    for r in rows:
        assert int(r.deviation) == sum((3 * a - b) ** 2 for a, b in zip(x[r.vec_id - 1], s))


def negatives(rows, anchor, positives=5, negatives=5, margin=(80, 100)):
    """Every anchor against every row."""
    q = {}
    for i, v, label in rows:
        one = (label, [max(-(2**20), min(2**20, math.floor(256 * float(np.float32(c))))) for c in v])
        q[i] = max(q.get(i, one), one)
    out = set()
    for a in filter(anchor, q):
        scores = sorted((-sum(map(int.__mul__, q[a][1], v)), i) for i, (_, v) in q.items() if i != a)
        for ps, p in [(-s, i) for s, i in scores if q[i][0] == q[a][0]][:positives]:
            inside = [(-s, i) for s, i in scores if q[i][0] != q[a][0] and margin[0] * ps <= -100 * s <= margin[1] * ps]
            out |= {(a, p, k + 1, i, ps, s) for k, (s, i) in enumerate(inside[:negatives])}
    return out


def mined(df, *args, **kwargs):
    rows = hard_negatives.mine(df, *args, **kwargs).collect()
    got = {(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in rows}
    assert len(got) == len(rows)
    return got


def test_mining_equals_all_pairs(spark, vectors, monkeypatch):
    monkeypatch.setattr(hard_negatives, "PACK_ROWS", 20)  # several packs, and below several blocks
    monkeypatch.setattr(hard_negatives.plant, "__defaults__", (64,))
    usable = [(r[0], r[1], r[2]) for r in vector_rows() if r[0] is not None and r[2] is not None and r[1]
              and len(r[1]) == 12 and all(c is not None and math.isfinite(c) for c in r[1])]
    want = negatives(usable, lambda i: i % 10 == 0)
    assert want and mined(vectors, F.col("vec_id") % 10 == 0) == want
    other = negatives(usable, lambda i: i % 10 == 0, 2, 7, (30, 95))
    assert mined(vectors, F.col("vec_id") % 10 == 0, 2, 7, (30, 95)) == other
    assert mined(vectors.limit(0), F.col("vec_id") % 10 == 0) == set()
    assert mined(vectors, F.lit(None).cast("boolean")) == set()
    assert mined(vectors.withColumn("label", F.lit(1)), F.col("vec_id") % 10 == 0) == set()


def test_mining_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table.collect()]
    got = queries.op12_hard_negatives(spark, SF).collect()
    assert {tuple(r) for r in got} == negatives(rows, lambda i: i % 100 == 0)


def test_cover_tree_covers_and_skips():
    rng = np.random.default_rng(5)
    points = np.concatenate([c + rng.integers(-3, 4, (150, 8)) for c in rng.integers(-200, 200, (6, 8))] + [np.zeros((40, 8), int)])
    tree = hard_negatives.cover_tree(np.arange(len(points)), np.zeros(len(points), np.int64), points.astype(np.int64))
    distance, longest = hard_negatives.augmented_distances(tree.points.astype(float))
    assert sorted(tree.ids) == list(range(len(points)))

    def below(node):
        out = list(range(tree.first_leaf[node], tree.last_leaf[node]))
        for child in range(tree.first_child[node], tree.last_child[node]):
            out += below(child)
        return out

    for node in range(len(tree.center)):
        under = below(node)
        assert distance[tree.center[node], under].max() <= tree.radius[node]
        centers = [tree.center[c] for c in range(tree.first_child[node], tree.last_child[node])]
        if len(centers) > 1:
            apart = distance[np.ix_(centers, centers)] + np.eye(len(centers)) * 1e9
            assert apart.min() > max(tree.radius[c] for c in range(tree.first_child[node], tree.last_child[node]))
    # a window around one cluster scores few of the others' leaves
    counted = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                counted.append(key.stop - key.start)
            return super().__getitem__(key)

    query = tree.points[tree.ids.tolist().index(0)][None, :]
    top = int((query * query).sum())
    watched = hard_negatives.CoverTree(**{**tree.__dict__, "ids": tree.ids})
    object.__setattr__(watched, "labels", tree.labels.view(Counting))
    found = hard_negatives.search(watched, query, np.array([-1]), np.array([0]), np.array([[top - 50]]), np.array([[top]]), True, 9)
    scores = tree.points @ query[0]
    want = sorted((-s, i) for s, i in zip(scores.tolist(), tree.ids.tolist()) if top - 50 <= s <= top)[:9]
    assert [(-s, i) for s, i in zip(found[3].tolist(), found[2].tolist())] == want
    assert 0 < sum(counted) < len(points) / 3


def test_mining_of_large_components(spark):
    """Scores beyond 2 ** 53 are whole numbers still."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-4000, 4000) for _ in range(40)], i % 2) for i in range(120)] + [(999, [1e30] * 40, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    plain = [(i, v, label) for i, v, label in rows]
    q = {i: [max(-(2**20), min(2**20, math.floor(256 * c))) for c in v] for i, v, _ in plain}
    labels = {i: label for i, _, label in plain}
    got = mined(df, F.col("vec_id") % 20 == 0)
    assert got
    for a, p, _, n, ps, ns in got:
        assert ps == sum(map(int.__mul__, q[a], q[p])) and ns == sum(map(int.__mul__, q[a], q[n]))
        assert labels[a] == labels[p] != labels[n] and 80 * ps <= 100 * ns <= 100 * ps


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for kind, form in KINDS.items():
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_plain_forms():
    rng = random.Random(8)
    pieces = ["a@b.c", "@", "x.y_z@d-e.f.g", ".", "1.2.3.4", "256.1.1.1", "0001.02.3.255", "1.2.3.4.5.6", "4111 1111 1111 1111",
              "4111-1111-1111-1111", "5500000000000004", "+1 (800) 555-0199", "+4", "+", " ", "é", "日", "-", "7", "\n", "a", "_", "b@c"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert personal_data.base_spans(text) == plain_spans(text), text
    # very long runs take linear time
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+" + "1" * 300_000, "a@" * 150_000, "1-" * 150_000):
        personal_data.base_spans(text)


def brute_spans(texts):
    """doc by doc: base spans, and the words that disclose an entity, from counts over all texts."""
    low = [t.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)) for t in texts]
    words = [[(m.start(), m.end(), m.group()) for m in re.finditer(r"[^\x20\x09-\x0D]+", t)] for t in low]

    def bare(w):
        return w.strip(string.punctuation)

    def general(t):
        zeros = re.sub("[1-9]", "0", t)
        return "*" + (zeros if "0" in zeros else t[:3])

    documents = Counter()
    for ws in words:
        terms = {bare(w) for _, _, w in ws if len(w) >= 3}
        documents.update(terms | {general(t) for t in terms})
    named, joint, windows, near = Counter(), Counter(), {}, []
    for text, ws in zip(texts, words):
        spans = plain_spans(text)
        free = [(a, b, w) for a, b, w in ws if not any(a < e and s < b for _, s, e in spans)]
        here = {}
        for kind, s, e in spans:
            value = text[s:e].lower() if kind == "email" else text[s:e] if kind == "ip" else re.sub("[^0-9]", "", text[s:e])
            left, right = [w for w in free if w[1] <= s], [w for w in free if w[0] >= e]
            around = [bare(w) for _, _, w in left[-8:] + right[:8]]
            for t in around:
                if len(t) >= 3 and any(map(str.isalnum, t)):
                    for form in (t, general(t)):
                        here.setdefault(((kind, value), form), set()).add(" ".join(around))
            here.setdefault(((kind, value), None), set())
        named.update({e for e, t in here if t is None})
        joint.update(list(here))
        for k, v in here.items():
            windows.setdefault(k, set()).update(v)
        near.append((free, here))
    n = len(texts)

    def share(e, t):
        return math.log(joint[e, t] * n / (named[e] * documents[t])) / math.log(n / named[e])

    out = []
    for text, (free, here) in zip(texts, near):
        actions = {}
        for e, t in here:
            if t is None or t[0] == "*" or named[e] == n or joint[e, t] < 2 or len(windows[e, t]) < 2 or share(e, t) < 0.8:
                continue
            action = "generalise" if share(e, general(t)) < 0.8 else "remove"
            actions[t] = max(action, actions.get(t, action))
        added = sorted(
            (actions[bare(w)], a + w.index(bare(w)), a + w.index(bare(w)) + len(bare(w)))
            for a, b, w in free if bare(w) in actions
        )
        base = plain_spans(text)
        out.append((base, ",".join(f"{k}:{s}:{e}" for k, s, e in base + added)))
    return out


TEXTS = [
    None, "", " \n", "mail a@b.cd only", "no entity in this long and clean text about a harbour",
    *[f"Report {i}: the Zorblatt case, call +1 (800) 555-0199 or ask Harquist-Jones {i}x about the harbour." for i in range(6)],
    *[f"Another text {w}{i} speaks of the harbour and of number n{i}7 without anybody" for i in range(40) for w in ("alpha", "beta")],
    "Copy with 10.0.0.1 and rareword here", "Copy with 10.0.0.1 and rareword here", "Copy with 10.0.0.1 and rareword here",
    *[f"server{i} host 10.9.8.7 plate K{i}99 blue{i}" for i in range(5)],
    "x " * 50_000 + "long a.b@c.de end " + "1" * 2_000,
]


def test_personal_data_equals_brute_force(spark):
    schema = "doc_id long, text string, spans string, `row` string, term int, kept string"
    rows = [(None if i == 3 else i, t, "s", "r", 1, None) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in personal_data.personal_data(df).collect())
    want = Counter()
    for (i, t, *_), (base, spans) in zip(rows, brute_spans([t or "" for t in TEXTS])):
        kinds = Counter(k for k, _, _ in base)
        digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        want[(i, *[kinds[k] for k in KINDS], digest, spans)] += 1
    assert got == want
    told = " ".join(spans for *_, spans in got)
    assert "remove:" in told and "generalise:" in told  # the method decides, in both ways
    assert all("harbour" != TEXTS[r[0]][int(s):int(e)] for r in got if r[0] is not None and TEXTS[r[0]]
               for k, s, e in [x.split(":") for x in r[-1].split(",") if x])
    off = personal_data.personal_data(df, threshold=9.0).collect()
    assert not any("remove" in r.spans or "generalise" in r.spans for r in off)
    assert personal_data.personal_data(df.limit(0)).collect() == []

    clean = personal_data.sanitise(df)
    assert clean.columns == df.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[0] is None and texts[1] == "" and texts[4] == TEXTS[4] and texts[None] == "mail [email] only"
    assert "Zorblatt" not in texts[5] and "[phone]" in texts[5] and "harbour" in texts[5]


def test_personal_data_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r.spans for r in queries.op13_personal_data(spark, SF).collect()}
    assert got == {r.doc_id: spans for r, (_, spans) in zip(table, brute_spans([r.text or "" for r in table]))}
