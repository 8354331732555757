"""Merkle manifest, language-model scores and vector codes: edge cases, and plain
versions that work row by row."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from claimlens.llm import anchors, maxent, merkle
from conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, branch string, digest string, kids string, learn string, chunk string, total string"
LONG = " ".join(f"w{i % 3001}" for i in range(40_000))
ROWS = [(1, "Alpha beta", "en", "a", 10), (2, None, "en", None, None), (3, "", None, "b", 0), (None, "no ID", "en", "a", 5), (4, LONG, "é", "c", 1),
        (4, LONG, "é", "c", 1), (5, " \t\n", "z", "", -7), (6, "Ω漢字 É", None, "a", 6), (None, None, None, None, None), (7, "x" * 200_000, "en", "a", 9),
        (8, "same id", "en", "a", 1), (8, "Same ID again", "en", "a", 1)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, g, s, n, *["clash"] * 6) for i, t, g, s, n in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# -- 11: manifest

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(i, text, lang, source, n):
    fields = [None if x is None else str(x) for x in (i, source, lang, n, text)]
    return H(*["-" if x is None else f"{len(x.encode())}:{x}" for x in fields])


def tree_of(leaves):
    """Levels of digests from the leaves to the root."""
    out = [list(leaves)]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path_of(tree, i):
    for level in tree[:-1]:
        run = level[i // 8 * 8:i // 8 * 8 + 8]
        yield run[:i % 8], run[i % 8 + 1:]
        i //= 8


def manifest_of(rows):
    langs = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees, order = {}, {}
    for lang in langs:
        order[lang] = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is None, r[0] or 0, leaf_of(*r)))
        trees[lang] = tree_of([leaf_of(*r) for r in order[lang]])
    top = tree_of([trees[lang][-1][0] for lang in langs])
    out = []
    for j, lang in enumerate(langs):
        for k, (i, text, g, s, n) in enumerate(order[lang]):
            path = [*path_of(trees[lang], k), *path_of(top, j)]
            bad = i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and text is not None
            own = leaf_of(i, text.translate({c: c + 32 for c in range(65, 91)}) if bad else text, g, s, n)
            for left, right in path:
                own = H(*left, own, *right)
            root = top[-1][0]
            out.append((i, trees[lang][0][k], trees[lang][-1][0], root, H(*[d for a, b in path for d in a + b]), own, own == root))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def got_manifest(df):
    return sorted([tuple(r[c] for c in COLUMNS) for r in merkle.manifest(df).collect()], key=str)


def test_manifest_of_odd_rows(odd, none):
    assert got_manifest(odd) == manifest_of(ROWS)
    assert merkle.manifest(none).count() == 0


@pytest.mark.parametrize("n", [1, 8, 9, 65])
def test_manifest_of_one_language_at_run_edges(spark, n):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(n)]
    got = got_manifest(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert got == manifest_of(rows) and len({r[3] for r in got}) == 1


def test_manifest_of_many_languages_and_partitions(spark):
    rows = [(i, f"Text {i}", f"l{i % 70}" if i % 3 else "en", "s", i) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert got_manifest(docs.repartition(13)) == manifest_of(rows)


def test_a_changed_byte_changes_the_root(spark):
    rows = [(i, f"text {i}", "en", "s", i) for i in range(20)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    root = merkle.manifest(spark.createDataFrame(rows, schema)).first().root
    changed = [*rows[:7], (7, "text 8", "en", "s", 7), *rows[8:]]
    assert merkle.manifest(spark.createDataFrame(changed, schema)).first().root != root


# -- 12: language-model scores

def tokens_of(text):
    return [*(text or "").encode().lower().split(), b" "]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def base_of(rows):
    counts = Counter(w for i, t in rows if not held(i) for w in tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        words = tokens_of(t)
        out.append((i, held(i), len(words), sum(counts[w] > 0 for w in words), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), 6)))
    return sorted(out, key=str)


def got_base(df):
    return sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()], key=str)


def test_scores_of_odd_rows(odd, none):
    out = maxent.scored(odd)
    assert got_base(out) == base_of([(i, t) for i, t, *_ in ROWS])
    assert all(math.isfinite(r.score) and r.score <= 0 for r in out.collect())
    assert maxent.scored(none).count() == 0
    unlearnt = odd.where("crc32(cast(doc_id as string)) % 7 = 2")
    assert {r.train_tokens for r in maxent.scored(unlearnt).collect()} <= {0}


def test_many_hash_ranges_count_alike(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    monkeypatch.setattr(maxent, "RANGE", 500)                         # read on the driver: many hash ranges
    assert got_base(maxent.scored(docs.repartition(7))) == base_of(rows)


def test_long_texts_are_cut_at_spaces_only(monkeypatch):
    monkeypatch.setattr(maxent, "PIECE", 7)
    text = b"Alpha betagamma  delta\nepsilon z" * 5
    numbers = maxent.numbers_of_words()
    seq = maxent._sequence(text, numbers)
    back = {n: w for w, n in numbers.items()}
    assert [back[int(n)] for n in seq] == tokens_of(text.decode())


def test_model_beats_unigrams_on_held_out_texts(spark):
    rows = maxent.scored(spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/documents.parquet")).where("held_out").collect()
    n = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / n > sum(r.base_score for r in rows) / n + 0.05


def test_chances_add_up_to_one():
    """Over all words, seen and unseen, in any context."""
    rng = np.random.default_rng(3)
    words = [maxent.END] + [f"w{i}".encode() for i in range(300)]
    counts = {w: int(c) for w, c in zip(words, rng.integers(1, 50, len(words)))}
    by = {}
    for w, c in counts.items():
        by.setdefault(maxent.word_class(w), []).append((c, w))
    classes = [(k, sum(c for c, _ in ws), len(ws)) for k, ws in by.items()]
    members, member = [], {}
    for k, ws in by.items():
        for m, (c, w) in enumerate(sorted(ws, reverse=True)[:5], 1):
            members.append((k, m, c, hash(w)))
            member[w] = m
    model = maxent.Model(maxent.Units(classes, members))
    model.of_class[:] = rng.normal(size=model.of_class.shape)
    model.of_member[:] = rng.normal(size=model.of_member.shape)
    rows = np.array([[5], [901]])
    of_class = model.chances(0, rows, np.array([0]))[0].astype(float)
    total = 0.0
    for k in range(maxent.CLASSES):
        of_member = model.chances(1, rows, np.array([k]))[0].astype(float)
        assert abs(of_member.sum() - 1) < 1e-5
        rest = sum(c + 1 for c, w in by.get(k, []) if w not in member) + 1
        assert abs(rest - model.units.rest[k]) < 1e-9
        total += of_class[k] * (sum(of_member[member[w]] for c, w in by.get(k, []) if w in member) + of_member[0])
    assert abs(total - 1) < 1e-5


def test_a_step_lowers_the_loss():
    rng = np.random.default_rng(1)
    model = maxent.Model(maxent.Units([(0, 10, 1), (1, 20, 2), (2, 30, 3)], []))
    rows, classes = rng.integers(0, 50, (2, 400)).astype(np.uint16), rng.integers(0, 3, 400)
    classes[rows[0] < 25] = 1
    visits = np.zeros((2, maxent.ROWS), np.int64)
    loss = lambda: -np.log(model.chances(0, rows, classes)[np.arange(400), classes]).mean()
    before = loss()
    for _ in range(20):
        model.step(0, rows, classes, classes, visits)
    assert loss() < before - 0.3 and visits[0].sum() == 20 * 2 * 400


# -- 13: vector codes

def codes_of(rows):
    kept = [(i, v, y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    x = np.array([[math.floor(1024 * c) for c in v] for _, v, _ in kept], dtype=object)
    first = {}
    for (i, _, _), row in sorted(zip(kept, x.tolist()), key=lambda z: (z[0][0] is None, z[0][0] or 0, z[1])):
        first.setdefault(i, row)
    start = list(first.values())[:256]
    width = len(x[0]) // 4
    parts = [x[:, p * width:(p + 1) * width] for p in range(4)]
    books = [[row[p * width:(p + 1) * width] for row in start] for p in range(4)]
    nearest = lambda row, book: min((sum((a - b) ** 2 for a, b in zip(row, e)), j) for j, e in enumerate(book))
    for _ in range(4):
        for p in range(4):
            found = [nearest(row, books[p])[1] for row in parts[p]]
            for j in set(found):
                own = [row for row, f in zip(parts[p], found) if f == j]
                books[p][j] = [sum(c) // len(own) for c in zip(*own)]
    best = [[nearest(row, books[p]) for row in parts[p]] for p in range(4)]
    errors = [sum(best[p][k][0] for p in range(4)) for k in range(len(kept))]
    labels = Counter()
    for (_, _, y), e in zip(kept, errors):
        labels[y] += e
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted([(i, "".join(f"{best[p][k][1]:02x}" for p in range(4)), errors[k], labels[y], digest) for k, (i, _, y) in enumerate(kept)], key=str)


VECTORS = "vec_id long, embedding array<float>, label int, vector string, trees string, rows string, name string"


def got_codes(df):
    return sorted([(r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in anchors.coded(df).collect()], key=str)


@pytest.mark.parametrize("n, grid", [(40, 2), (700, 3), (900, 400)])
def test_codes_equal_plain_rounds(spark, n, grid, monkeypatch):
    """Coarse grids make ties and equal points; small trees make many balls."""
    rng = np.random.default_rng(n)
    data = rng.integers(-grid, grid + 1, (n, 8)).astype(float) / 7 + (rng.integers(0, 4, (n, 1)) * 3 if grid > 3 else 0)
    rows = [(int(i), [float(np.float32(x)) for x in v], None if i % 5 == 0 else int(i % 3)) for i, v in zip(rng.permutation(n) * 3, data)]
    rows += [(rows[0][0], rows[0][1], 1), (None, rows[1][1], 1), (10_000, None, 1), (10_001, [None] + [0.0] * 7, 1), (10_002, [float("nan")] * 8, 0), (10_003, [float("-inf")] * 8, None)]
    df = spark.createDataFrame([(*r, *["clash"] * 4) for r in rows], VECTORS).repartition(3)
    assert got_codes(df) == codes_of(rows)


def test_balls_are_wholly_owned_and_entries_struck_out():
    """Four far groups: most balls end with one candidate and cached sums."""
    rng = np.random.default_rng(2)
    centres = np.array([[0, 0], [9000, 0], [0, 9000], [9000, 9000]])
    points = centres[rng.integers(0, 4, 2000)] + rng.integers(-300, 300, (2000, 2))
    tree, entries = anchors.Tree(points), centres + 50
    found = list(tree.walk(entries))
    assert len(found) < 20 and all(len(left) == 1 for _, left in found)
    assert sum(int(tree.count[node]) for node, _ in found) == 2000
    near = ((points[:, None] - entries[None]) ** 2).sum(2).argmin(1)
    sums, counts = tree.totals(entries)
    assert all((sums[j] == points[near == j].sum(0)).all() and counts[j] == (near == j).sum() for j in range(4))
    assert (tree.codes(entries)[0] == near).all()


def test_vectors_that_cannot_be_coded(spark):
    rows = [(1, [0.5, 1.5, 2.5, 3.5], 1), (2, [1.0], 1), (3, [], 2), (4, [1e30, 0.0, 0.0, 0.0], None), (5, [0.5, 1.5, 2.5, 3.0], 1), (0, [], 1)]
    got = {r.vec_id: r for r in anchors.coded(spark.createDataFrame([(*r, *["c"] * 4) for r in rows], VECTORS)).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4, 5] and got[2].code is got[3].code is got[4].code is got[4].error is None
    assert (got[1].code, got[5].code, got[1].error) == ("00000000", "00000001", 0) and got[2].label_error == 0 and got[3].label_error is None
    assert anchors.coded(spark.createDataFrame([], VECTORS)).count() == 0
