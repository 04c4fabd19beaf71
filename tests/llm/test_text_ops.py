"""Quality rules, BPE, license scans, HTML: against brute force and on edge tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brightlake.llm import bpe, html, licenses, quality, queries
from brightlake.llm import text as T
from tests.llm.helpers import EXTRA, SCHEMA, SF, WORD, edge_rows, edge_table, words

ODD = st.text(alphabet="ab 'sdlrevmt\n\t 12é½ß\x1c\x85\xa0 \U0001f600.", max_size=60)


def counts(text):
    w, seen, dup = words(text), set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    found, covered = Counter(zip(w, w[1:], w[2:])), set()
    for i, k in enumerate(zip(w, w[1:], w[2:])):
        if found[k] > 1:
            covered |= {i, i + 1, i + 2}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered))


def test_quality_counts_and_verdicts(spark):
    out = quality.score_quality(edge_table(spark)).collect()
    assert len(out) == len(edge_rows())
    expect = Counter()
    for k, t, *_ in edge_rows():
        n = counts(t)
        expect[(k, *n, n[0] < 50 or 100 * n[4] > 50 * n[0])] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                    r.n_repeat_words, r.base_failed) for r in out) == expect
    assert not any(r.kept for r in out if r.base_failed)
    assert quality.score_quality(edge_table(spark, [])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(ODD | st.none(), max_size=6))
def test_quality_counts_of_any_texts(texts):
    got = []
    for _, _, chunk in T.chunks(pa.array(texts, pa.string()), limit=40):
        c = quality.base_counts(chunk)
        got += list(zip(*[c[k].tolist() for k in quality.SCORE_COLUMNS]))
    assert got == [counts(t) for t in texts]


def test_rule_order_changes_no_verdict(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toArrow()["text"].combine_chunks()
    verdicts = []
    for rules in (quality.RULES, quality.RULES[::-1]):
        kept = []
        for _, _, chunk in T.chunks(docs):
            alive = ~quality.base_failed(quality.base_counts(chunk))
            kept += quality.run_cascade(chunk, rules, alive).tolist()
        verdicts.append(kept)
    assert verdicts[0] == verdicts[1] and 0 < sum(verdicts[0]) < len(verdicts[0])


def test_keep_good_carries_columns(spark):
    docs = edge_table(spark)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert all(getattr(r, "kept") == "own kept" for r in kept.collect())
    assert quality.keep_good(edge_table(spark, [])).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(queries.vocabulary_path())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.vocabulary_path())


def test_forced_boundaries_are_inside_no_token(vocabulary):
    for token in random.Random(1).sample(sorted(vocabulary.ids), 5000):
        assert vocabulary.fragments(token) == [token]


@settings(max_examples=150, deadline=None)
@given(ODD | st.text(max_size=40) | st.text(alphabet="ab<|endoftx>", max_size=40))
def test_bpe_equals_the_library(vocabulary, library, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = library.encode(text, add_special_tokens=False).ids
    assert vocabulary.encode(text) == ids
    assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_bpe_query_equals_the_library(spark, library):
    path = queries.vocabulary_path()
    out = bpe.digests(edge_table(spark), path).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expect = Counter()
    for k, t, *_ in edge_rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        expect[(k, len(ids), sha(",".join(map(str, ids))),
                sha(library.decode(ids, skip_special_tokens=False)))] += 1
    assert Counter(map(tuple, out)) == expect
    back = bpe.decode(bpe.encode(edge_table(spark), path), path)
    assert Counter(map(tuple, back.collect())) == Counter((k, t or "") for k, t, *_ in edge_rows())
    assert bpe.digests(edge_table(spark, []), path).count() == 0


def test_licenses_found_and_only_those(spark):
    rnd = random.Random(2)
    noise = lambda n: " ".join(rnd.choice(["lorem", "ipsum", "dolor", "sit"]) + str(rnd.randrange(99))
                               for _ in range(n))
    rows, expect = [], Counter()
    for i, (name, notice) in enumerate(licenses.TEMPLATES.items()):
        rows.append((i, f"{noise(i)} {notice.upper()}\n{noise(40)}", None, None, 0))
        expect[(i, name)] += 1
    mit = licenses.TEMPLATES["MIT"].split()
    mit[20] = "changed"
    rows += [(50, " ".join(mit), None, None, 0), (51, noise(200), None, None, 0),
             (52, " ".join(mit[:25]), None, None, 0),
             (53, " ".join([licenses.TEMPLATES["MIT/line"]] * 3), None, None, 0)]
    expect[(50, "MIT")] += 1
    out = licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    found = Counter((r.doc_id, r.license) for r in out)
    assert {k: n for k, n in found.items() if k[0] != 53} == expect
    assert found[(53, "MIT/line")] >= 1
    assert all(r.containment >= 0.8 for r in out)
    assert licenses.scan(edge_table(spark)).count() == 0
    assert licenses.scan(edge_table(spark, [])).count() == 0


def test_license_windows_miss_no_position():
    known = licenses.Templates(licenses.TEMPLATES)
    for pad in range(40):
        for name in ("MIT/line", "GPL-3.0/line", "BSD-3-Clause"):
            text = " ".join(f"w{i}" for i in range(pad)) + " " + licenses.TEMPLATES[name] + " tail"
            hits = [h for _, _, c in T.chunks(pa.array([text])) for h in licenses.matches(c, known)]
            assert [known.names[h[1]] for h in hits] == [name] and hits[0][2] == pad


def license_hits(text, templates=None):
    known = licenses.Templates(licenses.TEMPLATES if templates is None else templates)
    return [(known.names[h[1]], h[2]) for _, _, c in T.chunks(pa.array([text]))
            for h in licenses.matches(c, known)]


def test_license_notices_in_a_row_are_each_found():
    two, three, mit = (licenses.TEMPLATES[n] for n in ("GPL-2.0/line", "GPL-3.0/line", "MIT/line"))
    assert license_hits(f"{two} {three}") == [("GPL-2.0/line", 0), ("GPL-3.0/line", 12)]
    assert license_hits(f"{three} {two}") == [("GPL-3.0/line", 0), ("GPL-2.0/line", 12)]
    assert license_hits(" ".join([mit] * 3)) == [("MIT/line", 5 * i) for i in range(3)]
    for name in ("MIT", "GPL-3.0", "Apache-2.0", "GPL-2.0/line", "BSD-3-Clause"):
        notice = licenses.TEMPLATES[name]
        n = len(re.findall(r"[A-Za-z0-9]+", notice))
        for times in (2, 3, 4, 7):
            assert license_hits(" ".join(["pad"] * 9 + [notice] * times)) == [
                (name, 9 + n * i) for i in range(times)]
    # A part of a notice before it, and words put into it.
    assert license_hits(f"is licensed under the GNU General {three}") == [("GPL-3.0/line", 6)]
    gpl = licenses.TEMPLATES["GPL-3.0"].split()
    more = " ".join(gpl[:30] + ["x"] * 25 + gpl[30:])
    assert license_hits(f"{more} {more}") == [("GPL-3.0", 0), ("GPL-3.0", len(re.findall(r"\w+", more)))]


def test_license_notices_are_not_taken_for_each_other():
    for name in licenses.TEMPLATES:
        assert license_hits(licenses.TEMPLATES[name]) == [(name, 0)]
    free = ("This {work} is free software; you can redistribute it and/or modify it under the terms of "
            "the GNU {name} as published by the Free Software Foundation; either version {v} of the "
            "License, or (at your option) any later version. This {work} is distributed in the hope "
            "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
            "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. ")
    for work in ("program", "library"):
        for name, v, found in (("General Public License", "2", "GPL-2.0"),
                               ("General Public License", "3", "GPL-3.0"),
                               ("Affero General Public License", "3", "AGPL-3.0"),
                               ("Lesser General Public License", "2.1", "LGPL-2.1"),
                               ("Lesser General Public License", "3", "LGPL-3.0")):
            whole = free + "See the GNU {name} for more details."
            if work == "library" and name[0] != "L":
                continue
            for text in (free, whole):
                got = license_hits(text.format(work=work, name=name, v=v))
                assert [(n.split("/")[0], at) for n, at in got] == [(found, 0)], (work, name, v, got)
    bsd = licenses.TEMPLATES["BSD-3-Clause"].replace("the copyright holder nor", "Some University nor")
    assert license_hits(bsd) == [("BSD-3-Clause", 0)]
    assert license_hits("Licensed under the MIT License") == [("MIT/licensed", 0)]


PAGE = """<html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav>Menu <a href=x>a</a></nav><div class="cookie-notice">We use</div>
<main><article class="post"><h1>Real &eacute; title</h1><p>One <b>bo</b>ld &amp; x<p class=ad>Buy
<p>Two&nbsp;three   {}<ul><li>i1<li>i2</ul><form>F<input></form><script>if(a<b){{}}</script>
<aside>side</aside><section id="comments"><article class=comment><p>nice</p></article></section>
</article><div class="related">rel</div></main><footer>foot</footer></body></html>"""


def test_html_article_and_bare_pages(spark):
    rows = [(i, f"https://h.example/{i}", PAGE.format(i)) for i in range(3)]
    rows += [(10 + i, f"https://bare.example/{i}",
              "<div>The same long line of links stands on every page here</div>"
              f"<div>page{i} own{i} text{i}</div><nav>menu</nav>") for i in range(3)]
    rows += [(20, None, None), (21, "x", ""), (None, "https://h.example/z", "<p>only one page"),
             (22, "https://one.example/", "plain <b>text"), (22, "https://one.example/", "plain <b>text"),
             (23, "https://h.example/q", "<article><p>cut off <b"),
             (24, "https://h.example/r", "<article>" + "<p>many words " * 30000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select(
        "*", *[F.lit(0).alias(c) for c in EXTRA])
    out = {}
    for r in html.extract(pages).collect():
        out.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    for i in range(3):
        assert out[i] == [f"Real é title One bold & x Two three {i} i1 i2"]
        assert out[10 + i] == [f"page{i} own{i} text{i}"]
    assert out[20] == out[21] == [""] and out[None] == ["only one page"]
    assert out[22] == ["plain text"] * 2 and out[23] == ["cut off"]
    assert out[24] == [" ".join(["many words"] * 30000)]
    assert html.extract(pages.limit(0)).count() == 0


def test_html_repeated_runs_decide_in_and_outside_articles(spark):
    """Whole blocks of runs that the host repeats go; phrases of a sentence, and texts under
    several addresses, stay."""
    share = "<p>Write to us today and<p>get all the news of the week"     # in the article, on every page
    page = "<article><h1>Title {0}</h1><p>own{0} text{0} of page{0} is long enough, longer than the rest {0}" + share + "</article>"
    rows = [(i, f"https://h.example/{i}", page.format(i)) for i in range(12)]
    rows += [(20 + i, f"https://few.example/{i}", page.format(i)) for i in range(4)]
    menu = "<div>one two three</div><div>four five six seven eight</div>"
    rows += [(30 + i, f"https://bare.example/{i}",
              f"{menu}<p>own{i} he said that this is not at all what they wanted {i}</p>") for i in range(4)]
    rows += [(40 + i, f"https://two.example/{i}", f"<p>one text that stands under two addresses, whole</p><p>{i}")
             for i in range(2)]
    rows += [(50 + i, f"https://same.example/{i}", f"<nav>menu {i}</nav><article><p>a text that stands under "
              f"many addresses of a host</p><p>{i}</article>") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r.text for r in html.extract(pages).collect()}
    for i in range(12):
        assert out[i] == f"Title {i} own{i} text{i} of page{i} is long enough, longer than the rest {i}"
    for i in range(4):
        assert out[20 + i].endswith(f"rest {i} Write to us today and get all the news of the week")
        assert out[30 + i] == f"own{i} he said that this is not at all what they wanted {i}"
    for i in range(2):
        assert out[40 + i] == f"one text that stands under two addresses, whole {i}"
    for i in range(20):
        assert out[50 + i] == f"a text that stands under many addresses of a host {i}"


def test_html_stretches_make_all_runs_of_blocks():
    """Blocks inside any equal run of 8 tokens or more, by comparing all runs, are those that
    stretches of equal rank cover."""
    rnd = random.Random(7)
    for _ in range(40):
        shared = [[rnd.choice("abcd") for _ in range(rnd.randint(1, 11))] for _ in range(6)]
        two = [[rnd.choice([*shared, [rnd.choice("xyz")] * rnd.randint(1, 9)]) for _ in range(12)]
               for _ in range(2)]
        known = []
        found = {tuple(sum(two[1][a:b + 1], [])) for a in range(12) for b in range(a, 12)}
        for page in two:
            codes = np.array([html._token_code(t) for b in page for t in b], dtype=np.uint64)
            known.append([(int(r), a, b) for r, a, b in zip(*html.stretches(
                codes, np.array([len(b) for b in page])))])
        other = {r for r, _, _ in known[1]}
        covered = {i for r, a, b in known[0] if r in other for i in range(a, b + 1)}
        assert covered >= {i for a in range(12) for b in range(a, 12) for i in range(a, b + 1)
                           if sum(map(len, two[0][a:b + 1])) >= 8
                           and any(two[1][c:c + b + 1 - a] == two[0][a:b + 1] for c in range(12 - b + a))}
        assert covered <= {i for a in range(12) for b in range(a, 12) for i in range(a, b + 1)
                           if tuple(sum(two[0][a:b + 1], [])) in found}


def test_suffix_ranks_equal_prefixes():
    rnd = random.Random(3)
    tokens = [rnd.choice("abc") for _ in range(400)]
    ranks = html.suffix_ranks(tokens, 4)
    by = {}
    for i, r in enumerate(ranks.tolist()):
        by.setdefault(r, set()).add(tuple(tokens[i:i + 4]))
    assert len(ranks) == 397 and all(len(v) == 1 for v in by.values())
    assert len(by) == len({tuple(tokens[i:i + 4]) for i in range(397)})


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_hashes_tell_self_similar_texts_apart(n):
    """A polynomial modulo 2 ** 64 gives these two words one hash, whatever its base."""
    one, two = thue_morse(n), thue_morse(n, "b", "a")
    (_, _, chunk), = T.chunks(pa.array([f"{one} {two} {one}", two]))
    a, b, c, d = chunk.word_hashes().tolist()
    assert a == c and b == d and a != b


def test_queries_tell_self_similar_lines_apart(spark):
    from brightlake.llm import lm, neardup
    one, two = thue_morse(2048), thue_morse(2048, "b", "a")
    rows = [(1, f"{one}\n{two}\nx", None, None, 0), (2, one, None, None, 0), (3, two, None, None, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {r.doc_id: r.n_dup_lines for r in quality.score_quality(docs).collect()} == {1: 0, 2: 0, 3: 0}
    assert {r.doc_id: r.component_id for r in neardup.components(docs, words=4).collect()} == {1: 1, 2: 2, 3: 3}
    known = {r.doc_id: r.n_known for r in lm.score(docs, docs["doc_id"] == 2).collect()}
    assert known == {1: 2, 2: 2, 3: 1}     # of the words and the end
