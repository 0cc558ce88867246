"""Corpus operators against brute force, and their defined results for unusual rows."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwright.llm import (
    common, decontaminate, html_extract, jaccard_join, line_dedup, mixing, near_dup, quality, queries, token_count, token_store,
    url_filter,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rep long, task string, hash long"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))


def docs(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, "t", 9) for i, t, s in rows], DOCS)


ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, LONG, "b"), (5, LONG, "b"), (6, "One two", "a"), (6, "One two", "a"),
    (7, "a b c d e f g h i j k l", "c"), (None, "a b c d e f g h i j k l", "c"), (9, "ÉÀ ß 日本語 one", "c"),
]


def words(text):
    fold = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", fold)


# --- URL filter ---------------------------------------------------------------------------------------------------------------


def test_url_rules_and_odd_urls(spark):
    rows = [
        (1, "http://A.Example.NET/en/x?q"), (2, "https://b.net"), (3, "https://b.net/"), (4, "x.org/fr/"), (5, None),
        (6, "http://fr.org/fr/a"), (7, "http://notexample.com/de/1"), (8, "http://example.com/de/1#t"), (8, "http://example.com/de/1#t"),
        (9, "http://h/" + "s/" * 500), (None, "ftp://é.net/É/"),
    ]
    df = spark.createDataFrame([(*r, "p", 0.5) for r in rows], "page_id long, url string, path string, purity double")
    got = url_filter.filter_urls(df, queries.RULES).collect()
    by = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert len(got) == len(rows)
    assert by[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert by[2] == ("b.net", "", None, "allow") and by[3][2:] == ("net/", "block")
    assert by[4] == ("", "", None, "allow") and by[5] == ("", "", None, "allow")
    assert by[6][2:] == ("org/fr/", "allow") and by[7][2] is None and by[8][2:] == ("example.com/de/", "block")
    assert by[None][2:] == ("net/", "block")
    assert url_filter.filter_urls(df.limit(0), queries.RULES).count() == 0


def test_bad_template_is_rejected(spark):
    rows = [(i, f"http://h.com/{'spam' if i % 2 else 'good'}/{i}") for i in range(60)]
    rows += [(100 + i, f"http://h.com/spam/{i}/de") for i in range(3)]
    labelled = spark.createDataFrame(rows, "page_id long, url string")
    host, path = url_filter.url_parts(F.col("url"))
    bad = F.when(F.col("page_id") < 60, (F.col("page_id") % 2).cast("int")).alias("bad")
    df = labelled.select(host.alias("host"), url_filter.path_segments(path).alias("raw"), bad)
    got = {(r["raw"][0], len(r["raw"])): r["rejected"] for r in url_filter.template_verdicts(df).collect()}
    assert got[("spam", 2)] is True and got[("good", 2)] is False and got[("spam", 3)] is False


def test_deep_branches_are_told_apart(spark):
    deep = "/a/b/c/d/e/f"
    rows = [(f"http://h.com{deep}/{'spam' if i % 2 else 'good'}/x{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}", i % 2) for i in range(60)]
    rows += [(f"http://h.com{deep}/spam/new", None), (f"http://h.com{deep}/spam/new/", None), ("http://other.com" + "/s" * 400, None)]
    rows += [("http://h.com//", None), ("http://h.com", None)]
    urls = spark.createDataFrame(rows, "url string, bad int")
    host, path = url_filter.url_parts(F.col("url"))
    df = urls.select(host.alias("host"), url_filter.path_segments(path).alias("raw"), "bad")
    got = url_filter.template_verdicts(df).collect()
    assert len(got) == 60 + 3
    for r in got:
        if len(r["raw"]) == 8 and r["raw"][-1] != "new":
            assert r["rejected"] is (r["raw"][6] == "spam")
    assert next(r for r in got if r["host"] == "other.com")["template"] == "/s" * 400
    assert [r["template"] for r in got if not r["raw"]] == [""]
    # A prior above the threshold does not reject what nobody labelled.
    bad = df.withColumn("bad", F.when(F.col("bad").isNotNull(), 1))
    assert not any(r["rejected"] for r in url_filter.template_verdicts(bad).collect() if r["host"] == "other.com" or not r["raw"])
    # Visits of one path do not hide that its level is variable.
    many = spark.createDataFrame([("h", [f"n{chr(97 + i)}"], None) for i in range(20) for _ in range(5)], "host string, raw array<string>, bad int")
    assert {r["template"] for r in url_filter.template_verdicts(many).collect()} == {"/*"}


# --- near duplicates ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [1024, 8])
def test_near_duplicates_equal_brute_force(spark, block):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 16))
    rows = [base[i % 60] + (0 if i < 60 else 0.12) * rng.standard_normal(16) for i in range(240)] + [base[0]] * 3
    unit = np.stack(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    extra = [(500, None), (501, []), (502, [0.0] * 16), (503, [float("nan")] * 16), (504, [None] * 16), (505, [1.0, 2.0]), (None, rows[0].tolist())]
    df = spark.createDataFrame([(i, r.tolist(), 1, "h", 1) for i, r in enumerate(rows)] + [(*e, 1, "h", 1) for e in extra],
                               "vec_id long, embedding array<double>, label int, vec string, rep int")
    got = near_dup.near_duplicates(df, recall=0.999, block=block).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r["vec_id"]: r for r in got}
    links = np.array([by[i]["n_links"] for i in range(len(rows))])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.99 * near.sum()
    for i in range(500, 506):
        assert (by[i]["n_links"], by[i]["component_id"], by[i]["kept"]) == (0, i, True)
    assert by[240]["component_id"] == by[0]["component_id"] and not by[241]["kept"]
    assert (by[None]["n_links"], by[None]["component_id"], by[None]["kept"]) == (0, None, False)
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("finish", [1, 30, 400_000])
def test_components_of_chains_and_stars(spark, monkeypatch, finish):
    monkeypatch.setattr(common, "_FINISH", finish)
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(6, 60)] + [(59, 100)] + [(900, 901)]
    random.Random(1).shuffle(chain)
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(chain, "a long, b long").repartition(7)).collect()}
    assert set(got.values()) == {5, 900} and len(got) == 55 + 61 + 2


# --- Jaccard join -------------------------------------------------------------------------------------------------------------


def brute_components(rows):
    sets = {}
    for i, t, _ in rows:
        w = words(t)
        if i is not None:
            sets[i] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = {k: new if v == old else v for k, v in label.items()}
    return {i: (len(s), label[i]) for i, s in sets.items()}


@pytest.mark.parametrize("block", [512, 2])
def test_jaccard_components_equal_brute_force(spark, block):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(300)]
    rows, at = [], 20
    for size in (1, 2, 3, 9, 10, 11, 12, 30, 60, 61, 150):
        text = [rng.choice(vocabulary) for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, 3):
            copy = list(text)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((at, " ".join(copy).upper() if at % 2 else "\n".join(copy), "s"))
            at += 1
    rows = [r for r in ODD if r[0] != 6] + rows
    got = jaccard_join.jaccard_components(docs(spark, rows), block=block).collect()
    want = brute_components(rows)
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert [(r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is None] == [(10, None)]
    if block == 512:
        assert jaccard_join.jaccard_components(docs(spark, rows).limit(0)).count() == 0


def test_search_links_probes_long_lists():
    rng = np.random.default_rng(5)
    common_part = rng.integers(1, 1 << 60, 95).astype(np.uint64)
    sets = [np.unique(np.append(common_part, rng.integers(1, 1 << 60, n).astype(np.uint64))) for n in (5, 4, 60, 3)]
    a, b = jaccard_join.search_links(np.arange(4), sets, np.arange(4), np.zeros(4, int), 90, 100)
    assert {x for p in zip(a, b) for x in p} == {0, 1, 3}


def test_unrelated_documents_with_common_passages_are_not_searched_together(spark, monkeypatch):
    rng = random.Random(12)
    passages = [" ".join(f"p{k}x{i}" for i in range(12)) for k in range(6)]
    rows = []
    for i in range(0, 480, 2):
        own = [" ".join(f"u{i}x{n}" for n in range(at, at + 12)) for at in range(0, 120, 12)]
        text = " ".join(rng.sample(own + rng.sample(passages, 5), 15))
        rows += [(i, text, "s")] + ([(i + 1, text + " end", "s")] if i % 40 == 0 else [])
    dealt, search = [], jaccard_join._search

    def counted(rows, *rest):
        dealt.append(rows.count())
        return search(rows, *rest)

    monkeypatch.setattr(jaccard_join, "_search", counted)
    got = jaccard_join.jaccard_components(docs(spark, rows), 5, 80, 100, block=16).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i - i % 2 for i, _, _ in rows}
    assert sum(dealt) < len(rows)  # 12 pairs of copies and what they meet, not all documents, block against block


def test_similar_sets_share_one_of_their_rarest_shingles():
    rng = np.random.default_rng(9)
    bounds = jaccard_join.size_classes(1 << 12, 80, 100)
    draw = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64)
    tables = rng.integers(0, 9, 1 << 20), rng.integers(0, 256, 1 << 22).astype(np.uint8)
    for both in (1, 4, 5, 8, 40, 80, 400, 799):
        for rest in (0, both // 4):  # similarity is 0.8 at least
            for left in {0, rest // 2, rest}:
                common = draw(both)
                a, b = (np.unique(np.append(common, draw(n))) for n in (left, rest - left))
                sa, sb = (jaccard_join.prefix_signatures(s, tables, 7, bounds, 80, 100) for s in (a, b))
                assert len(np.intersect1d(sa, sb))
                assert not len(np.intersect1d(sa, jaccard_join.prefix_signatures(b, tables, 8, bounds, 80, 100)))


# --- decontamination ----------------------------------------------------------------------------------------------------------


def brute_hits(text, items, n=10):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, held = find(text), set(), set()
    for item, body in items:
        b = find(body)
        for k in range(max(1, len(b) - n + 1)) if b else []:
            win = b[k:k + n]
            for p in range(len(w) - len(win) + 1):
                if w[p:p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    held.add(str(item))
    return len(w), len(hit), sorted(held)


def test_decontamination_equals_brute_force(spark):
    items = [(1, "A b c D e f g h i j k l."), (2, "one, TWO"), (3, None), (4, "..."), (12, "b c d e f g h i j k"), (5, "éà ß")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [*ODD, (10, ".a b c d e f g h i j, k! x a b one. two", "s"), (11, "ÉÀ ß", "s")]
    df = docs(spark, rows)
    for limit in (500_000, 0):  # broadcast, and beyond the bound
        got = decontaminate.find_hits(df, bench, broadcast_windows=limit).collect()
        assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in got) == sorted(
            (str(i), *brute_hits(t, items)) for i, t, _ in rows)
    unique = docs(spark, [r for r in rows if r[0] != 6])
    kept = {r["doc_id"] for r in decontaminate.decontaminate(unique, bench).collect()}
    assert kept == {1, 2, 3, 4, 5, 9, 11, None}
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(unique, bench, mode="spans").collect()}
    assert re.findall(r"\w+", cut[10]) == ["x", "a", "b"] and cut[4] == LONG and cut[1] is None
    assert decontaminate.find_hits(df, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.find_hits(df.limit(0), bench).count() == 0


# --- token store --------------------------------------------------------------------------------------------------------------


def test_token_store_round_trip(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    tool = Tokenizer.from_file(path)
    rows = [*ODD, (12, "it's <|endoftext|> .. a. b.", "s"), (-5, "x", "s")]
    store, listed = token_store.write_store(docs(spark, rows), path, shard_docs=3)
    got = token_store.store_digests(store, listed).collect()
    assert len(got) == len(rows)
    start, seen = 0, {}
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tool.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        seen.setdefault(i, []).append((start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    for i, want in seen.items():
        assert sorted((r["start"], r["n_tokens"], r["ids_crc32"]) for r in got if r["doc_id"] == i) == want
    strange = spark.createDataFrame([(i,) for i in range(5000, 5400)], "doc_id long").select(
        "doc_id", token_store.key_hash("doc_id", "doc_id").alias("hash"))
    assert store.lookup(strange).filter("shard is not null").count() == 0
    empty, none = token_store.write_store(docs(spark, ODD).limit(0), path)
    assert token_store.store_digests(empty, none).count() == 0


def test_perfect_hash_is_a_bijection():
    for n in (1, 2, 5, 4000):
        keys = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
        shift, slots = token_store.build_mph(keys)
        assert sorted(slots) == list(range(n)) and (token_store.mph_slots(keys, shift, n) == slots).all()


# --- token counts -------------------------------------------------------------------------------------------------------------


def test_token_counts_equal_library(spark):
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    tool = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_count.count_tokens(docs(spark, ODD), path).collect()
    want = [(i, len((t or "").encode()), len(tool.encode(t or "")), len(tool.encode(t or "")) > 4096) for i, t, _ in ODD]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    rng, letters = random.Random(2), [*"ab \n\té1.▁", "  ", "the", "\r\n", "</s>", "日"]
    counter = token_count.transducer(path)
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert {counter.count(text, c) for c in (1, 2, 5, 65536)} == {len(tool.encode(text))}, repr(text)
    assert token_count.count_tokens(docs(spark, ODD).limit(0), path).count() == 0


# --- line deduplication -------------------------------------------------------------------------------------------------------


def test_line_dedup_keeps_the_earliest(spark):
    line = "alpha beta gamma delta epsilon zeta"
    rows = [(3, f"x\n{line}\ny", "s"), (2, f"{line.upper()}\nhead", "s"), (4, f"{line}\nz\n  alpha  beta gamma delta epsilon zeta", "s"),
            (5, None, "s"), (6, "", "s"), (8, "x\nx", "s"), (9, LONG, "s"), (10, LONG, "s")]
    found = line_dedup.repeated_units(docs(spark, rows), line_dedup.LINES, 0).collect()
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["removed"]] for r in found}
    n = len(line)
    assert got == {2: [], 3: [(2, 3 + n)], 4: [(0, n + 1), (n + 3, 2 * n + 6)], 5: [], 6: [], 8: [(0, 2), (2, 3)], 9: [], 10: [(0, len(LONG))]}
    texts = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeats(docs(spark, rows), line_dedup.LINES, 0).collect()}
    assert texts[3] == "x\ny" and texts[4] == "z\n" and texts[2].startswith("ALPHA") and texts[5] is None and texts[10] == ""
    assert line_dedup.repeated_units(docs(spark, rows).limit(0)).count() == 0
    odd = line_dedup.repeated_units(docs(spark, ODD)).collect()
    assert len(odd) == len(ODD) and all(r["n_units"] == 0 for r in odd if r["doc_id"] in (1, 2))


def test_repeated_passages_over_lines_and_in_scripts_without_spaces(spark):
    rng = random.Random(11)
    sentence = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(9)) + ". "
    passage = [sentence() for _ in range(5)]
    split = "".join(passage[:2]).rstrip() + "\n" + "".join(passage[2:])
    unspaced = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(230)) + "。"
    rows = [
        (1, sentence() + "".join(passage) + sentence(), "s"),  # the earliest
        (2, "Own words first. " + split + "own end", "s"),  # over two lines and from the middle of one
        (3, passage[0] + sentence() + passage[3] + sentence(), "s"),  # single repeated sentences: too short
        (4, "前。" + unspaced + "後。", "s"), (5, unspaced, "s"), (6, None, "s"),
    ]
    got = {r["doc_id"]: r for r in line_dedup.repeated_units(docs(spark, rows)).collect()}
    assert [(got[i]["n_repeated"], got[i]["n_removed"]) for i in range(1, 7)] == [(5, 0), (5, 5), (0, 0), (1, 0), (1, 1), (0, 0)]
    texts = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeats(docs(spark, rows)).collect()}
    assert texts[2] == "Own words first. own end" and texts[5] == "" and texts[1] == rows[0][1] and texts[6] is None


# --- mixing -------------------------------------------------------------------------------------------------------------------


def test_mix_meets_targets(spark):
    rng = random.Random(7)
    rows = [(i, " ".join("w" * rng.randint(1, 40)), "abc"[0 if i < 30 else 1 + i % 2]) for i in range(300)] + [(900, None, None), (901, "q q", None)]
    got = mixing.mix(docs(spark, rows), [5, 2, 1]).collect()
    size = {s: sum(r["size"] for r in got if r["source"] == s) for s in ("a", "b", "c", None)}
    total = sum(size.values())
    target = {r["source"]: r["target"] for r in got}
    assert abs(sum(target.values()) - total) < 1e-6 and target["a"] == 3 * size["a"]
    for s in target:
        taken = sum(r["taken"] for r in got if r["source"] == s)
        assert abs(taken - target[s]) <= 80 and all(r["taken"] <= 3 * r["size"] for r in got)
    again = mixing.mix(docs(spark, rows).repartition(5), [5, 2, 1]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(mixing.mix(docs(spark, ODD), [5, 2, 1]).collect()) == len(ODD)
    assert mixing.mix(docs(spark, ODD).limit(0), [5, 2, 1]).count() == 0


# --- HTML ---------------------------------------------------------------------------------------------------------------------

ARTICLE = "<h1>Title &amp; more</h1><p>First&nbsp;paragraph with <b>bold</b> words and enough text to read.</p><p>Second one<br>goes on for a while too.</p>"
WANT = "Title & more First paragraph with bold words and enough text to read. Second one goes on for a while too."


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div class='content'>{}</div>", "<div>{}"])
def test_html_main_text(wrap):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=/>Home</a></nav>"
        "<div class='cookie-notice'>We use cookies</div><ul class=menu><li><a href=/a>A</a></li></ul>" + wrap.format(ARTICLE)
        + "<form><input><label>Mail</label></form><aside>Related</aside><div id='comments'><p>Great post, thanks a lot for writing it!</p></div>"
        "<script>if (a < b) { x('</p>') }</script><footer>&copy; me</footer></body></html>"
    )
    assert html_extract.extract(page) == WANT


BODY = "".join(f"<p>Paragraph {i} of the body goes on with enough words to be read as running text.</p>" for i in range(6))
BODY_TEXT = " ".join(f"Paragraph {i} of the body goes on with enough words to be read as running text." for i in range(6))
TEASER = "<article><h3>Next story</h3><p>Read on here.</p></article>"
COMMENTS = "".join(f"<article class='comment'><p>Comment {i} thanks the author at some length.</p><p>And again.</p></article>" for i in range(9))


@pytest.mark.parametrize("page", [
    f"<div>{BODY}</div>{TEASER}",  # the mark is on a teaser only
    f"{TEASER}<div>{BODY}</div>",
    f"<article>{BODY}</article>{COMMENTS}",  # comments marked as articles
    f"<div>{BODY}</div>{COMMENTS}",
    f"<div>{BODY}</div><div id='comments'><article><p>A comment without a class of its own.</p></article></div>",
    f"<div class='layout has-sidebar'><div>{BODY}</div><div class='sidebar'><p>Links and more</p></div></div>",
    f"<div class='layout search'><div>{BODY}</div><div class='sidebar'><p>Links and more</p></div></div>",  # a frame with a noise word
    f"<div class='header-visible share'><article>{BODY}</article></div><div class='related'>{TEASER}</div>",
    f"<div>{BODY}</div><div class='related'>{TEASER}</div>",
    f"<article class='post comments-open'>{BODY}</article><div class='ad'>Buy this.</div>",
    f"<main>{BODY}</main><div>Small print.</div>",
])
def test_html_region_weighs_the_mark(page):
    assert html_extract.extract(f"<html><body><nav><a href=/>Home</a></nav>{page}<footer>end</footer></body></html>") == BODY_TEXT


def test_html_body_partly_marked():
    first, rest = BODY[: BODY.index("<p>Paragraph 2")], BODY[BODY.index("<p>Paragraph 2") :]
    assert html_extract.extract(f"<body><article>{first}</article><div>{rest}</div></body>") == BODY_TEXT
    assert html_extract.extract("<body><div class='ad'>A longer text of an advertisement than that.</div><article><p>Short.</p></article></body>") == "Short."


def test_html_odd_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "plain  text"), (4, "u", "<p>a<p>b"), (4, "u", "<p>a<p>b"), (5, "u", "</div><"), (None, "u", f"<p>{LONG}</p>")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in html_extract.extract_pages(df).collect()]
    texts = {i: t for i, t, _ in got}
    assert len(got) == len(rows) and all(len(t) == n for _, t, n in got)
    assert (texts[1], texts[2], texts[3], texts[4], texts[None]) == ("", "", "plain text", "a b", LONG)
    assert html_extract.extract_pages(df.limit(0)).count() == 0


# --- quality ------------------------------------------------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    sf = "/root/testdata/sf0.01"
    scored = queries.op10_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert (scored["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in scored["doc_id"]]).all()
    held = scored[scored["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.95


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1), (4, 1), (7, 0), (77, 1), (9, None), (None, 1)], "doc_id long, quality int")
    got = quality.score_documents(docs(spark, ODD), labels, quality.learnable(), keep=True).collect()
    assert len(got) == len(ODD) and all(0 <= r["_score"] <= 1 for r in got)
    none = quality.score_documents(docs(spark, ODD), labels.limit(0), quality.learnable()).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.score_documents(docs(spark, ODD).limit(0), labels, quality.learnable()).count() == 0


# --- pipeline -----------------------------------------------------------------------------------------------------------------


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/documents.parquet")
    frame, columns = given, given.columns
    for name, stage in corpus_pipeline.STAGES:
        before = frame.toPandas()
        frame = stage(spark, frame, sf)
        after = frame.toPandas()
        if name != "tokens":
            assert frame.columns == columns
            frame = spark.createDataFrame(after, given.schema)
        ids, left = set(before["doc_id"]), set(after["doc_id"])
        if name == "near_duplicates":
            want = brute_stage_components([(r.doc_id, r.text) for r in before.itertuples()])
            assert left == {i for i, c in want.items() if i == c}
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
            assert left == {r.doc_id for r in before.itertuples() if not brute_hits(r.text, items)[1]}
        if name == "mixing":
            size = lambda df: sum(len(words(t)) for t in df["text"])
            assert left <= ids and abs(size(after) - size(before)) <= 0.05 * size(before)
        if name == "tokens":
            assert len(after) == len(before)
    whole = corpus_pipeline.run(spark, sf).toPandas()
    assert sorted(whole["ids_crc32"]) == sorted(after["ids_crc32"])
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")

def brute_stage_components(rows, width=5, num=80, den=100):
    """The rule of the pipeline's stage: 5-word shingles, similarity 0.8 or more."""
    sets, label = {}, {i: i for i, _ in rows}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = {k: new if v == old else v for k, v in label.items()}
    return label


def test_pipeline_stage_removes_copies_of_five_words_and_eight_tenths(spark):
    import corpus_pipeline

    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(400)]
    rows, at = [(1, None), (2, ""), (3, "a b c"), (4, "A b  c"), (5, "a b d")], 10
    for size in (4, 5, 6, 12, 30, 61, 150, 400):
        text = [rng.choice(vocabulary) for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, 3, 5, 8):
            copy = list(text)
            for _ in range(edits):
                copy[rng.randrange(size)] = rng.choice(vocabulary)
            rows.append((at, " ".join(copy)))
            at += 1
    spread = list(range(100))
    changed = [f"e{i}" if i in (30, 70) else f"w{i}" for i in spread]  # 3 words: 92 of 104 (0.885); 5 words: 86 of 106 (0.811)
    rows += [(900, " ".join(f"w{i}" for i in spread)), (901, " ".join(changed))]
    want = brute_stage_components(rows)
    assert want[901] == 900 and brute_components([(i, t, "s") for i, t in rows])[901][1] == 901
    given = docs(spark, [(i, t, "s") for i, t in rows])
    got = corpus_pipeline.keep_one_of_each(spark, given, "")
    assert {r["doc_id"] for r in got.collect()} == {i for i, c in want.items() if i == c}
    for block in (512, 2):
        found = jaccard_join.jaccard_components(given, 5, 80, 100, block=block).collect()
        assert {r["doc_id"]: r["component_id"] for r in found} == want
    op3 = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(given).collect()}
    assert op3[901] == 901  # the query keeps 3 words and 0.9
