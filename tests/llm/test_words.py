"""Spelling variants, tokenizer alignment and personal data against brute-force versions."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cartwright.llm import personal_data, queries, spelling, token_align
from tests.llm.test_corpus import LONG, ODD, docs

SF = "/root/testdata/sf0.001"


# --- spelling variants --------------------------------------------------------------------------------------------------------


def brute_variants(rows, ratio=10):
    """word -> (form, root, n, n_near, form_n) by deleting each letter of every word."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    count = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{key}:{run}".encode()) if key is not None else 1
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                count[run] += 1
    count = {w: n for w, n in count.items() if n >= 2}
    near = {w: set() for w in count}
    holes = collections.defaultdict(set)
    for w in count:
        for i in range(len(w)):
            holes[w[:i] + "\0" + w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in count:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-count[v], v), default=None)
        if best and count[best] >= ratio * count[w]:
            form[w] = best
    out = {}
    for w in count:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, count[w], len(near[w]), count.get(form.get(w)))
    return out


def table(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


@pytest.mark.parametrize("limits", [{}, {"max_list": 20, "part": 40}])
def test_variants_equal_brute_force(spark, limits):
    """Small limits make long grams frequent and cut their lists into parts."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_variants([(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()])
    assert table(spelling.spelling_variants(documents, **limits)) == want


def test_variants_of_planted_words_chains_and_odd_rows(spark):
    rng = random.Random(2)
    letters = "abcdefgéÿ"
    base = ["".join(rng.choice(letters) for _ in range(rng.choice((7, 8, 11, 15, 40, 130)))) for _ in range(60)]
    texts = []
    for word in base:
        i = rng.randrange(len(word))
        nearby = [word[:i] + "z" + word[i + 1 :], word[:i] + "q" + word[i:], word[:i] + word[i + 1 :]]
        texts += [" ".join([word.upper() if word.isascii() else word] * 40), " ".join(nearby * 3), " ".join(nearby[:1] * 2)]
    texts += ["chainss " * 400, "chainsse " * 30, "chainssef " * 3, "repeaté 7repeaté-repeaté"]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + ODD
    got = table(spelling.spelling_variants(docs(spark, rows), max_list=30, part=50))
    want = brute_variants([r[:2] for r in rows])
    assert got == want and got["chainssef"][:2] == ("chainsse", "chainss")
    assert spelling.spelling_variants(docs(spark, rows).limit(0)).count() == 0


def test_gram_bounds_hold_for_every_single_edit():
    """At least T grams of a word are found again, at their place from the left or the right, after any one edit."""
    rng = np.random.default_rng(3)
    words = rng.integers(97, 101, (300, 9)).astype(np.uint8)
    levels = []
    for q in (3, 4, 5):
        codes, n = np.unique(spelling._packed(words, q), return_counts=True)
        levels.append(codes[n > 40 // q])
    cap = 4
    lengths = spelling.decompose(words, levels, cap)
    same, longer = spelling.bounds(words, lengths, levels, cap)
    assert same.min() >= 1 and longer.min() >= 1
    for w in range(0, 300, 7):
        mine = {(bytes(words[w, p : p + k]), p) for p, k in enumerate(lengths[w]) if k}
        for i in range(10):
            for letter in (97, 98, 100):
                other = np.insert(words[w], i, letter)[None]
                theirs = spelling.decompose(other, levels, cap)[0]
                found = {(bytes(other[0, p : p + k]), p) for p, k in enumerate(theirs) if k}
                assert sum((g, p) in found or (g, p + 1) in found for g, p in mine) >= longer[w]
                if i < 9 and words[w, i] != letter:
                    other = words[w : w + 1].copy()
                    other[0, i] = letter
                    theirs = spelling.decompose(other, levels, cap)[0]
                    found = {(bytes(other[0, p : p + k]), p) for p, k in enumerate(theirs) if k}
                    assert len(mine & found) >= same[w]


# --- tokenizer alignment ------------------------------------------------------------------------------------------------------

FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def pair():
    return token_align.Pair(*map(queries.tokenizer_path, FILES))


def brute_alignment(both, text):
    none = (0, 0, 0, 0, "", [])
    if not text:
        return none
    a, b, raw = both._plain(" " + text), both._b.encode(text), (" " + text).encode()
    if b"".join(both.a_bytes[i] for i in a) != raw or b"".join(both.b_bytes[i] for i in b) != raw:
        return none
    a_span, b_span, links, groups = [], [], [], []
    for ids, table_, spans in ((a, both.a_bytes, a_span), (b, both.b_bytes, b_span)):
        at = 0
        for i in ids:
            spans.append((at, at + len(table_[i])))
            at = spans[-1][1]
    ends = sorted({e for _, e in a_span} & {e for _, e in b_span})
    j = 0
    for x, (lo, hi) in enumerate(a_span):
        while b_span[j][1] <= lo:
            j += 1
        k = j
        while k < len(b) and b_span[k][0] < hi:
            links.append((a[x], b[k]))
            k += 1
    at = bt = 0
    for end in ends:
        i, k = at, bt
        while at < len(a) and a_span[at][1] <= end:
            at += 1
        while bt < len(b) and b_span[bt][1] <= end:
            bt += 1
        groups.append(",".join(map(str, a[i:at])) + "|" + ",".join(map(str, b[k:bt])))
    return len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def test_alignment_of_odd_strings_for_any_piece_size():
    both, rng = pair(), random.Random(5)
    letters = "ab cdeéß \n\n  \t中文\U0001f600▁'sIİ\x00\x0b <s></s><|endoftext|>123!?.-  \x1c\r"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(1500)]
    texts += [None, "", " ", "\n", " \n", "a ", " a", "\na", "a\n b", "a\n\nb", "a 's b", LONG]
    want = [brute_alignment(both, t) for t in texts]
    for size in (2, 7, 65_536):
        got = token_align.align(both, texts, size)
        rows = zip(*(got[k].tolist() for k in ("n_a", "n_b", "n_groups", "n_links")), got["groups"])
        assert list(rows) == [w[:5] for w in want]
        assert [(c & 0xFFFFF, c >> 20) for c in got["codes"].tolist()] == [link for w in want for link in w[5]]


def test_merge_pieces_give_the_whole_merge():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(rng.integers(1, 400, 60))
        b = np.unique(rng.integers(1, 400, 90))
        a, b = np.append(a, 400), np.append(b, 400)
        whole = token_align.merge_ends(a, b, 10_000)
        for size in (2, 3, 16):
            assert all(np.array_equal(x, y) for x, y in zip(whole, token_align.merge_ends(a, b, size)))
            i, j = token_align.diagonals(a, b, size)
            assert np.diff(i + j).max() <= size + 1


@pytest.mark.parametrize("chunk", [20_000, 16_000_000])
def test_alignment_counts_over_the_corpus(spark, chunk):
    both = pair()
    rows = [(r["doc_id"], r["text"], "s") for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    rows += [r for r in ODD if r[0] is not None] + [(77, "a▁b", "s")]
    files = list(map(queries.tokenizer_path, FILES))
    got = token_align.align_tokenizers(docs(spark, rows).repartition(3), *files, chunk=chunk).collect()
    brute = [(key, brute_alignment(both, text)) for key, text, _ in rows]
    count = collections.Counter(link for _, b in brute for link in b[5])
    top = collections.defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    want = [(key, *b[:4], sum(count[x] == top[x[1]] for x in b[5]), sum(count[x] for x in b[5]), b[4]) for key, b in brute]
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(tuple(r[c] for c in columns) for r in got) == sorted(want)
    assert token_align.align_tokenizers(docs(spark, rows).limit(0), *files).count() == 0


# --- personal data ------------------------------------------------------------------------------------------------------------


def brute_spans(text):
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in twice) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice(rng.choice(("0123456789", "+.@- ()", "ab@.%_", "12.-+"))) for _ in range(rng.randrange(60)))
        assert [(personal_data.KINDS[k - 1], a, b) for k, a, b in personal_data.base_spans(text)[0]] == brute_spans(text)
    assert personal_data.base_spans("x" * 2_000_000 + "@" + "1" * 500_000)[0] == []


def test_repeats_of_personal_data_are_found(spark):
    phone = "call +1 (743) 555-3824 now"
    rows = [(i, f"words {phone} and from 10.0.0.{i} or a{i}@mail.example.com about version 2.0 of 1999", "s") for i in range(40)]
    rows += [
        (100, f"{phone}; later dial (743) 555-3824 again", "s"), (101, "only version 2.0 of 1999 and 12 items", "s"),
        (102, "4465758382889437 4465758382889437 twice", "s"), (103, "number 4465758382889438 fails", "s"),
    ] + [(i, "card 4465758382889437 here", "s") for i in range(110, 120)] + ODD
    found = {r["doc_id"]: r for r in personal_data.find_personal_data(docs(spark, rows)).collect()}
    texts = {r[0]: r[1] for r in rows}
    for key, r in found.items():
        base = [tuple(s) for s in r["base"]]
        assert base == brute_spans(texts[key]) and set(base) <= {tuple(s) for s in r["spans"]}
    extra = lambda k: [texts[k][s["start"] : s["end"]] for s in found[k]["spans"] if s not in found[k]["base"]]
    assert extra(100) == ["(743) 555-3824"] and extra(101) == [] and extra(103) == [] and extra(0) == []
    assert extra(102) == ["4465758382889437"] * 2
    assert personal_data.find_personal_data(docs(spark, rows)).count() == len(rows)
    assert personal_data.find_personal_data(docs(spark, rows).limit(0)).count() == 0


def test_messages_settle_on_exact_marginals_of_a_tree():
    model = personal_data.Model(np.empty((0, 3), np.int64), np.eye(5) * 9, np.eye(5) * 4)
    graph = personal_data.Graph()
    graph.features, graph.seen = [3, 40, 3, 3], [-2, 3, -2, -1]
    graph.chain, graph.skip = [(0, 1)], [(1, 2), (2, 3)]
    got = model.marginals(graph, rounds=60)
    weight = np.zeros((5,) * 4)
    for labels in np.ndindex(*weight.shape):
        if labels[1] == 3:
            weight[labels] = np.exp(model.chain[labels[0], labels[1]] + model.skip[labels[1], labels[2]] + model.skip[labels[2], labels[3]])
    weight /= weight.sum()
    want = [weight.sum(axis=tuple(k for k in range(4) if k != i)) for i in range(4)]
    assert np.allclose(got, want, atol=1e-6)
