"""Terms that disclose entities, against a plain count; odd numbers; names of any script and length."""

import math
import re

import pytest

from keyedlake.llm import pii
from keyedlake.llm.common import table

SF = "/root/testdata/sf0.001"


def disclosing(rows):
    """The disclosing terms by the docstring's formulas."""
    docs, with_entity, with_both = {}, {}, {}
    for doc_id, text in rows:
        text = text or ""
        docs.setdefault(doc_id, set()).update(re.findall(r"\w+", text.lower()))
        spans = pii.base_spans(text)
        covered = [range(a, b) for _, a, b in spans]
        for kind, a, b in spans:
            entity = pii._entity(kind, text[a:b])
            with_entity.setdefault(entity, set())
            before = [m.span() for m in re.finditer(r"\w+", text[:a])][-pii.REACH:]
            after = [(x + b, y + b) for x, y in (m.span() for m in re.finditer(r"\w+", text[b:]))][:pii.REACH]
            for x, y in before + after:
                if not any(x < r.stop and r.start < y for r in covered):
                    with_entity[entity].add(doc_id)
                    with_both.setdefault((entity, text[x:y].lower()), set()).add(doc_id)
    n, out = len(rows), set()
    for (entity, term), both in with_both.items():
        c_t, c_e = sum(term in words for words in docs.values()), len(with_entity[entity])
        information = math.log(n / c_e)
        if information > 0 and math.log(n * len(both) / ((c_t + pii.PRIOR) * c_e)) >= pii.DISCLOSURE * information - 1e-12:
            out.add(term)
    return out


def marked(df):
    return {r.doc_id: (sorted((s.begin, s.end) for s in r.terms), r.base) for r in pii.find(df).collect()}


def test_terms_match_a_plain_count(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    terms, got = disclosing(rows), marked(docs)
    assert terms
    for doc_id, text in rows:
        base = [(s.begin, s.end) for s in got[doc_id][1]]
        want = [m.span() for m in re.finditer(r"\w+", text or "") if m[0].lower() in terms
                and not any(a < m.end() and m.start() < b for a, b in base)]
        assert got[doc_id][0] == want


def test_a_name_is_masked_wherever_it_stands(spark):
    rows = [(i, f"Ordinary filler about daily life, part {i % 7}, with contact and note.") for i in range(300)]
    rows += [(1000 + i, f"Contact Zebulon Quark or 李雷 Li today at zq@x.org for a note {i % 7}") for i in range(3)]
    rows += [(2000, "zebulon QUARK lives here, far from any address. " + "filler " * 50 + "李雷 too, and Li.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    for i in (1000, 1001, 1002, 2000):
        for name in ("zebulon", "quark", "李雷", " li"):
            assert name not in clean[i].lower().replace("lives", "").replace("life", "").replace("filler", "")
    assert all(clean[i] == rows[i][1] for i in range(300)) and "lives here" in clean[2000]


def test_one_mention_is_enough(spark):
    rows = [(i, f"plain words {i % 5} about nothing") for i in range(400)] + [(900, "plain words by Oddname: odd@name.org")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms, _ = marked(df)[900]
    assert {rows[-1][1][a:b] for a, b in terms} == {"Oddname", "by"}


@pytest.mark.parametrize("text,want", [
    ("0" * 5000 + ".1.1.1", 1), ("1.1.1." + "0" * 6000 + "255", 1), ("1.1.1." + "0" * 6000 + "256", 0), ("9" * 5000 + ".1.1.1", 0),
    ("0.0.0.0", 1), ("000.000.000.000", 1), ("255.255.255.255", 1), ("1.1.1.256", 0), ("1.1.1.0255", 1)])
def test_ip_parts_of_any_length(text, want):
    assert len(pii.base_spans(text)) == want
