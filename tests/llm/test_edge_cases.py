"""Nulls, empty and very long texts, ties, repeated rows, empty tables and extra
columns whose names clash: every operator gives its stated result."""

import hashlib
import textwrap

import duckdb
import public_tokenizers as P
import pyarrow as pa
import pytest

import corpus_pipeline
from claimlens.llm import block_names, bpe, licences, minhash, mixing, quality, render, repeats, syncmers, token_files

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, part string, size string, kept string, "
          "score string, node string, name string, range string, extra string, bucket string, packed string")
LONG = " ".join(f"w{i % 7919}" for i in range(40_000))
PASSAGE = " ".join(f"p{i}" for i in range(30))
TEXTS = [(1, "Alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (None, "a row without an id"), (4, LONG), (4, LONG),
         (5, "ALPHA beta gamma delta epsilon zeta"), (6, PASSAGE + " tail one"), (7, "head two " + PASSAGE), (8, " \t\n"),
         (9, "x" * 100_000), (10, "Ω漢字 é ß"), (11, "word"), (12, "word"), (None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, None if (i or 0) % 3 == 0 else f"s{(i or 0) % 2}", None, *["clash"] * 11) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def low(text):
    return (text or "").encode().lower()


def test_exact_dedup(odd, none):
    rows = block_names.exact_groups(odd).collect()
    assert len(rows) == 14                                       # the repeated row is one document
    got = {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept) for r in rows}
    digest = lambda t: hashlib.sha256(low(t)).hexdigest()
    assert got[1, digest(TEXTS[0][1])] == (5, 2, False) and got[5, digest(TEXTS[0][1])] == (5, 2, True)
    assert got[2, digest("")] == (3, 3, False) and got[3, digest("")] == (3, 3, True) and got[None, digest("")] == (3, 3, False)
    assert got[4, digest(LONG)] == (4, 1, True) and got[11, digest("word")] == (12, 2, False)
    assert block_names.exact_groups(none).count() == 0


def test_blocks_of_any_length_name_texts_alike(spark):
    texts = ["", "a", "b", "ab" * 7, "ab" * 7, "ab" * 7 + "c", "ab" * 8, "é" * 9, "é" * 9, "É" * 9, "AB" * 7]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (1, 2, 3, 5, 100):
        got = by_id(block_names.exact_groups(docs, block), "keep_id")
        assert got == {i: (max(j for j, u in enumerate(texts) if low(u) == low(t)),) for i, t in enumerate(texts)}


def test_fingerprints(odd, none):
    rows = syncmers.fingerprints(odd, rows_per_bucket=2).collect()
    assert len(rows) == len(TEXTS)
    order = sorted(TEXTS, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        want.append((doc_id, len(text), hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in rows], key=key) == sorted(want, key=key)
    prints = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert prints[11].fingerprint == prints[12].fingerprint != "" and prints[11].near_next == 1.0
    assert prints[3].fingerprint == prints[2].fingerprint == "" and prints[2].near_next == 1.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert syncmers.fingerprints(none).count() == 0


def test_repeats(odd, none):
    got = by_id(repeats.without_repeats(odd, windows_per_range=50), "n_words", "n_removed", "kept_text")
    assert got[6] == (32, 0, PASSAGE + " tail one") and got[7] == (32, 30, "head two")
    words = LONG.split()
    assert got[4] == (40_000, 40_000 - 7919, " ".join(words[:7919]))
    assert got[2] == got[3] == got[8] == (0, 0, "") and got[1][1] == 0
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in repeats.without_repeats(odd).collect()}
    assert spans[7] == [(2, 32)] and spans[4] == [(7919, 40_000)] and spans[1] == []
    assert repeats.without_repeats(none).count() == 0


def test_near_groups(odd, none):
    got = by_id(minhash.near_groups(odd), "n_shingles", "component_id", "kept")
    assert got[1] == (2, 1, True) and got[5] == (2, 1, False)
    assert got[2] == (0, 2, True) and got[3] == (0, 3, True) and got[8] == (0, 8, True)       # empty sets link with nothing
    assert got[11] == (1, 11, True) and got[12] == (1, 11, False)
    assert got[4] == (7919, 4, True) and got[9] == (1, 9, True)
    assert {r.component_id for r in minhash.near_groups(odd).where("doc_id is null").collect()} == {None}
    assert minhash.near_groups(none).count() == 0


def test_mixing(odd, none):
    rows = mixing.mixed(odd).collect()
    assert len(rows) == 14
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert got[2].size == got[3].size == got[8].size == 0 and got[2].taken == 0
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in rows)
    sizes = {"s0": 12 and got[4]["size"], None: 0}
    assert got[4]["size"] == 40_000 and sizes
    again = {r.doc_id: r.taken for r in mixing.mixed(odd).collect() if r.doc_id is not None}
    assert again == {i: r.taken for i, r in got.items()}
    assert mixing.mixed(none).count() == 0


def test_quality(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.scored(odd, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert {r.score for r in quality.scored(odd, labels.where("quality = 9")).collect()} == {0.5}
    assert quality.scored(none, labels).count() == 0
    kept = quality.with_scores(odd, labels)
    assert kept.columns == [*[c for c in odd.columns if c != "score"], "score"] and kept.count() == len(TEXTS)


def test_bpe(odd, none):
    import tiktoken
    path = P.path("byte_bpe_multi_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rows = bpe.encoded(odd, path, P.PATTERN, ids=True).collect()
    assert sorted(r.ids for r in rows) == sorted(own.encode_ordinary(t or "") for _, t in TEXTS)
    assert sorted(r.decoded_sha256 for r in rows) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in TEXTS)
    assert bpe.encoded(none, path, P.PATTERN).count() == 0


def test_token_files(spark, odd, none, tmp_dir):
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    where = token_files.write_token_files(odd, f"{tmp_dir}/ids", path)
    rows = sorted(token_files.read_token_files(spark, where).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [1, 2, 3, 4, 4, 5, 6, 7, 8, 9, 10, 11, 12, None, None]
    start = 0
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in TEXTS if i is not None}
    for r in rows:
        assert r.start == start and r.n_tokens == len(r.ids) and (r.doc_id is None or list(r.ids) == want[r.doc_id])
        start += r.n_tokens
    assert [list(r.ids) for r in token_files.lookup(spark, where, 6).collect()] == [want[6]]
    plan = token_files.lookup(spark, where, 6)._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,6)" in plan
    assert token_files.token_digests(none, path).count() == 0


def test_starts_hold_whatever_files_the_rows_went_to(spark, tmp_dir):
    path = P.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(i, "some words of text " * (i % 5)) for i in range(200)], "doc_id long, text string").repartition(7)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 7)
    try:
        where = token_files.write_token_files(docs, f"{tmp_dir}/many", path)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    start = 0
    for r in sorted(token_files.read_token_files(spark, where).collect(), key=lambda r: r.doc_id):
        assert r.start == start
        start += r.n_tokens


def test_few_bytes_merge_as_many_do():
    encoder = bpe.Bpe(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    for text in (" reconnaissance", "ééé", "aaaaaaaaaaaaaaaa", "x", "", "Ωmega 123!?"):
        assert encoder.merge_few(text.encode()) == encoder.merge(text.encode())
    ids = list(range(3000))
    assert encoder.decode(ids) == b"".join(encoder.bytes_of[i] for i in ids)


def test_licences(spark, odd, none):
    assert licences.licences(odd).where("licences <> ''").count() == 0 and licences.licences(odd).count() == 14
    texts = ["The MIT License (MIT)\n\nCopyright (c) 2020 Someone\n\n" + licences._MIT.replace('"', "“").upper(), "prose\n  released under the MIT Licence\nmore",
             "Licensed under CC BY-NC 4.0.", "we are licensed under the sky", licences._ISC + " and more", "Copyright 2020 licence holder"]
    rows = by_id(licences.licences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")), "whole_licence", "licences", "notices")
    assert rows[0][:2] == ("MIT", "MIT") and rows[1] == (None, "MIT", 1) and rows[2] == ("CC-BY-NC-4.0", "CC-BY-NC-4.0", 1)
    assert rows[3] == rows[5] == (None, "", 0) and rows[4] == (None, "", 0)
    assert licences.licences(none).count() == 0
    forms = spark.createDataFrame(list(licences.KNOWN), "licence string, text string").select(licences.canonical(licences.F.col("text")).alias("form")).collect()
    assert all(any(sign in r.form for sign in licences.SIGNS) for r in forms)


def test_licence_sql_knows_what_the_operator_knows(spark):
    """Every known text, wrapped too, and lines on both sides of the notice rule."""
    lines = ["Copyright (c) 2020 A", "copyright: notice", "copyright : notice", "Copyright notice and this", "copyright by A", "copyright holders", "Copyright Owner B",
             "(c) B", "\u00a9 C", "All rights reserved.", "copyright", "copyright, D", "* Copyright E", "copyright to", "copyright tower", "a copyright 2020"]
    texts = [t for _, t in licences.KNOWN] + ["\n".join(textwrap.wrap(t, 72)) for _, t in licences.KNOWN]
    texts += [f"{line}\n\n{licences._ISC}\n{line}" for line in lines] + [f"{line}\nLicensed under the MIT License." for line in lines]
    rows = [*enumerate(texts), (-1, None), (-2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.register("frame", pa.table({"doc_id": [i for i, _ in rows], "text": pa.array([t for _, t in rows], pa.string())}))
    con.execute("CREATE VIEW documents AS SELECT * FROM frame")
    want = sorted(con.execute(licences.oracle()).fetchall(), key=lambda r: r[0])
    got = sorted(tuple(r) for r in licences.licences(docs).collect())
    assert got == want and sum(r[1] is not None for r in got) > len(licences.KNOWN)


def test_the_largest_id_is_no_null_id(spark):
    last, text = (1 << 63) - 1, " ".join(f"w{i}" for i in range(60))
    rows = [(7, text), (last, text), (None, text), (last, ""), (None, ""), (None, "few words")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    order = lambda r: (r.doc_id is None, r.doc_id or 0, str(r))
    got = sorted(minhash.near_groups(docs).select("doc_id", "n_shingles", "component_id", "kept").collect(), key=order)
    assert [tuple(r) for r in got] == [(7, 56, 7, True), (last, 0, last, True), (last, 56, 7, False), (None, 0, None, True), (None, 1, None, True), (None, 56, None, True)]
    got = sorted(repeats.without_repeats(docs).select("doc_id", "n_words", "n_removed").collect(), key=order)
    assert [tuple(r) for r in got] == [(7, 60, 0), (last, 0, 0), (last, 60, 60), (None, 0, 0), (None, 2, 0), (None, 60, 60)]
    got = sorted(block_names.exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept").collect(), key=order)
    assert [tuple(r) for r in got] == [(7, last, 3, False), (last, last, 2, True), (last, last, 3, True), (None, last, 2, False), (None, last, 3, False), (None, None, 1, True)]
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, corpus_pipeline.drop_copies(spark, docs, ""), "").collect()]
    assert sorted(kept, key=str) == sorted([(last, text), (last, ""), (None, "few words")], key=str)


def test_training_rows_are_bounded_though_ids_repeat(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", seen.extend)
    docs = spark.createDataFrame([(1 if i % 2 else 4, f"text {i}") for i in range(100)] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 7)], "doc_id long, quality int")
    quality.trained(docs, labels, rows=3)
    assert len(seen) == len(set(seen)) == 3


def test_rendered(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a<p>b", "clash"), (2, None, None, "clash"), (3, "u", "", "clash"), (None, "u", "<b>x", "clash"), (1, "u", "<p>a<p>b", "clash")],
                                  "page_id long, url string, html string, text string")
    rows = render.rendered(pages).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in rows) == [(0, "x", 1), (1, "a\n\nb", 4), (1, "a\n\nb", 4), (2, "", 0), (3, "", 0)]
    assert render.rendered(pages.where("page_id = 99")).count() == 0


def test_short_texts_without_closed_syncmers_differ(spark):
    texts = [" ".join(f"t{n}x{i}y{j}" for j in range(n)) for n in (6, 7, 8) for i in range(40)]
    rows = syncmers.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert "" not in {r.fingerprint for r in rows} and len({r.fingerprint for r in rows}) == len(texts)
    assert all(r.near_next < 1 for r in rows)


def test_texts_without_id_and_of_equal_32_bit_hashes_are_documents_of_their_own(spark):
    import corpus_pipeline
    from pyspark.sql import functions as F
    made = spark.range(300_000).select(F.concat_ws(" ", *[F.concat(F.lit(f"w{k}n"), "id") for k in range(24)]).alias("text"))
    pairs = made.groupBy(F.hash("text")).agg(F.collect_list("text").alias("same")).where("size(same) = 2").limit(3).collect()
    texts = [t for r in pairs for t in r.same]
    assert len(texts) == 6
    docs = spark.createDataFrame([(None, t, "en", "s", len(t)) for t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    assert minhash.near_groups(docs).count() == repeats.without_repeats(docs).count() == mixing.mixed(docs).count() == 6
    assert licences.licences(docs).count() == corpus_pipeline.drop_near_copies(spark, docs, "").count() == 6
    mixed = corpus_pipeline.mix(spark, docs, "").select("text").collect()
    assert {r.text for r in mixed} == set(texts) and len(mixed) == 9
    tail = " ".join(f"t{i}" for i in range(30))
    shared = spark.createDataFrame([(None, f"{t} {tail}") for t in texts] + [(1, tail)], "doc_id long, text string")
    assert sorted(r.n_removed for r in repeats.without_repeats(shared).collect()) == [0] + [30] * 6


def test_added_tokens_in_a_text_are_recognised(spark):
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    texts = ["end <|endoftext|> of", "a<|endoftext|>b", "<|EndOfText|> <|ENDOFTEXT|>x", "<|startoftext|><|endoftext|>!!", "Don't<|endoftext|>.", "<|endoftext|", "É<|endoftext|>É",
             "(<|endoftext|>)"]
    encoder = token_files.WordEncoder(path)
    for turn in (texts, texts[::-1]):
        got = encoder.encode([t.encode().split() for t in turn])
        want = [plain.encode(t, add_special_tokens=False).ids for t in turn]
        assert [[int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)] for ids in got] == want
    assert want[-1] == [806, 49407, 539]


@pytest.mark.parametrize("html, text", [
    ("<table>note<tr><td>a<td>b</table>", "note\n\na  b"),
    ("<table><p>note</p><tr><td>a<td>b</table>", "note\n\na  b"),
    ("x<table><center>note</center><tr><td>a</table>y", "x\nnote\n\na\n\ny"),
    ("<table><tr>note<td>a<td>b</tr> <tr><td>c</tr></table>", "note\n\na  b\nc"),
    ("<table><tbody><b>no<i>te</i></b><tr><td>a</tbody></table>", "note\n\na"),
    ("<table><form>note<tr><td>a<td>b</tr></form></table>", "note\n\na  b"),
    ("<table><caption>c</caption><tr><br><td>a<td>b</table>", "c\na  b"),
    ("<table><script>s</script><tr><td>a</table>", "a"),
    ("<p>a<xmp>x  <b>&amp;\n y</xmp>b", "a\n\nx  <b>&amp;\n y\n\nb"),
    ("<table><td>a<td>b</table>", "a  b")])
def test_text_in_tables_outside_cells_and_xmp(html, text):
    assert render.visible_text(html) == text


def test_wrapped_licence_texts_match(spark):
    import textwrap
    full = [(name, text) for name, text in licences.KNOWN if len(text) > 200]
    assert {name for name, _ in full} >= {"MIT", "ISC", "Zlib"}
    texts = {}
    for i, (name, text) in enumerate(full):
        for width in range(70, 81):
            wrapped = ["\n".join(textwrap.wrap(p, width, break_on_hyphens=False, break_long_words=False)) for p in text.split("\n")]
            texts[100 * i + width] = name, "Copyright (c) 2020 Someone\nCopyright by Others. All rights reserved.\nCopyright The Third\n\n" + "\n".join(wrapped)
    docs = spark.createDataFrame([(i, t) for i, (_, t) in texts.items()], "doc_id long, text string")
    assert by_id(licences.licences(docs), "whole_licence") == {i: (name,) for i, (name, _) in texts.items()}
    isc = licences._ISC.replace("that the above copyright", "that the above\ncopyright")
    assert licences.licences(spark.createDataFrame([(1, isc)], "doc_id long, text string")).first().whole_licence == "ISC"


def test_common_full_texts_are_known_and_a_user_can_add_some(spark):
    bsd = "Copyright (c) 2020, X\nAll rights reserved.\n\n" + licences._bsd(3, True)
    docs = spark.createDataFrame([(1, bsd), (2, licences._bsd(2, False)), (3, licences._APACHE), (4, licences._UNLICENSE), (5, licences._BSL), (6, "Do as you\nlike."), (7, "")],
                                 "doc_id long, text string")
    want = {1: ("BSD-3-Clause",), 2: ("BSD-2-Clause",), 3: ("Apache-2.0",), 4: ("Unlicense",), 5: ("BSL-1.0",), 6: (None,), 7: (None,)}
    assert by_id(licences.licences(docs), "whole_licence") == want
    own = spark.createDataFrame([("Own", "do as you like"), ("Empty", "Copyright 2020 X")], "licence string, text string")
    assert by_id(licences.licences(docs, own), "whole_licence") == {**want, 6: ("Own",)}


def test_batches_for_python_workers_are_small(spark, odd):
    """A batch of 10,000 long texts would lie outside the JVM's heap, twice."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        for given, wanted in (("64m", 8 << 20), ("4096", 4096)):
            for operator in (lambda: bpe.encoded(odd, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN),
                             lambda: quality.with_scores(odd.select("doc_id", "text"), spark.createDataFrame([], "doc_id long, quality int"))):
                spark.conf.set(name, given)
                operator()
                assert int(spark.conf.get(name).rstrip("b")) == wanted
    finally:
        spark.conf.set(name, before)
