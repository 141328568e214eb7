"""The ten operators against brute force on the small tables and on odd rows."""

import hashlib
import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keyedlake.llm import bpe, chat, pii, queries
from keyedlake.llm.common import table
from keyedlake.llm.components import connected_components
from keyedlake.llm.decontamination import WuManber, drop_contaminated, find_hits, words_of
from keyedlake.llm.exact_dedup import drop_copies, exact_groups
from keyedlake.llm.langid import identify, training_samples
from keyedlake.llm.near_dedup import drop_near_copies, near_duplicates
from keyedlake.llm.quality import classify, fit, keep_good
from keyedlake.llm.suffix_dedup import LENGTH, refine, remove_repeats
from keyedlake.llm.token_counts import Counter, apply_edit, build, recount

SF = "/root/testdata/sf0.001"
LONG = "word%d " * 30_000 % tuple(range(30_000))
PROSE = ("It was a bright cold day in April and the clocks were striking thirteen as Winston slipped quickly "
         "through the glass doors though not quickly enough to prevent a swirl of gritty dust")
ODD = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a"), (5, LONG), (6, LONG + "end"), (7, PROSE),
       (8, PROSE.upper()), (9, "  " + PROSE), (7, PROSE), (10, "naïve 日本語テキスト 😀 x"), (11, "é" * 3000),
       (None, PROSE), (None, None), (12, PROSE[:120] + " but then something else happened on that morning")]
#: Columns whose names clash with what the operators make.
EXTRA = ("kept", "group_size", "n_tokens", "content", "h128", "node", "spans", "items", "good", "row", "__keep_id")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    return rows.withColumns({c: F.lit(f"x{i}") for i, c in enumerate(EXTRA)}).withColumns(
        {"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0)})


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("1 = 0")


@pytest.fixture(scope="module")
def given(spark):
    return [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


# ------------------------------------------------------------------- 1: BPE
def _tiktoken():
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=queries.PATTERN, mergeable_ranks=bpe.load_ranks(queries.RANKS),
                             special_tokens={})


def _bpe_expected(rows):
    encoder = _tiktoken()
    out = []
    for doc_id, text in rows:
        ids = encoder.encode_ordinary(text or "")
        out.append((doc_id, len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(text or "")))
    return sorted(out, key=str)


def test_bpe_equals_tiktoken(spark, given):
    assert sorted(map(tuple, queries.op1_bpe(spark, SF).collect()), key=str) == _bpe_expected(given)


def test_bpe_odd_rows(odd, none):
    words = ["a" * 700, "ab" * 200 + " " * 90, "aaab" * 99, "<|endoftext|>", "'re 12 \n\n x", "ё" * 150]
    rows = [(i, w) for i, w in enumerate(words)]
    docs = odd.sparkSession.createDataFrame(rows, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    got = bpe.round_trip(docs, queries.RANKS, queries.PATTERN).collect()
    assert sorted(map(tuple, got), key=str) == _bpe_expected(rows + ODD)
    assert bpe.encode(none, queries.RANKS, queries.PATTERN).count() == 0
    back = bpe.decode(bpe.encode(docs, queries.RANKS, queries.PATTERN), queries.RANKS).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t in rows + ODD)
    assert bpe.tokenise(docs, queries.RANKS, queries.PATTERN).filter("not round_trip").count() == 0


# ---------------------------------------------------- 2: repeated substrings
def _repeats_expected(rows):
    first, out = {}, []
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - LENGTH + 1) if doc_id is not None else ():
            key = data[i:i + LENGTH]
            first[key] = min(first.get(key, doc_id), doc_id)
    for doc_id, text in rows:
        data = (text or "").encode()
        gone, covered = bytearray(len(data)), 0
        for i in range(len(data) - LENGTH + 1) if doc_id is not None else ():
            if first[data[i:i + LENGTH]] < doc_id:
                gone[max(i, covered):i + LENGTH] = b"\1" * (i + LENGTH - max(i, covered))
                covered = i + LENGTH
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g))))
    return sorted(out, key=str)


def test_repeats_equal_brute_force(spark, given):
    assert sorted(map(tuple, queries.op2_suffix_dedup(spark, SF).collect()), key=str) == _repeats_expected(given)


def test_repeats_odd_rows(odd, none):
    got = remove_repeats(odd).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == _repeats_expected(ODD)
    assert remove_repeats(none).count() == 0


def test_refine_groups_equal_strings():
    data = b"abracadabra" * 30 + bytes(range(200)) + b"abracadabra" * 9
    places = list(range(len(data) - LENGTH + 1))
    import numpy as np
    bucket = refine(data, np.array(places))
    by = defaultdict(set)
    for i in places:
        by[data[i:i + LENGTH]].add(int(bucket[i]))
    counts = defaultdict(int)
    for i in places:
        counts[data[i:i + LENGTH]] += 1
    assert all(len(v) == 1 and (v == {-1}) == (counts[k] == 1) for k, v in by.items())
    shared = [v for k, v in by.items() if counts[k] > 1]
    assert len(set(map(tuple, shared))) == len(shared)


# ------------------------------------------------------------------- 3: PII
BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+",
         lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and pii._luhn(re.sub("[^0-9]", "", m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)]


def _base(text):
    return [(k, m.start(), m.end()) for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m[0])]


def test_pii_base_spans(spark, given):
    want = {d: sha(",".join(f"{k}:{a}:{b}" for k, a, b in _base(t))) for d, t in given}
    got = queries.op3_pii(spark, SF).collect()
    assert {r.doc_id: r.base_sha256 for r in got} == want
    assert all(r.n_email + r.n_ip + r.n_card + r.n_phone <= r.spans.count(":") // 2 for r in got)


@pytest.mark.parametrize("text", [
    "a@b.c@d.ef", "..@x.y", "@a.b", "a@b", "x" * 5000 + "@", "1.2.3.4.5.6.7.8.9", "999.1.1.1", "0255.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (234) 567-8901.", "+1234", "1" * 6000 + ".1.1.1", "é a@b.de"])
def test_pii_odd_texts(text):
    if len(text) < 5000:
        assert pii.base_spans(text) == _base(text)
    else:
        assert pii.base_spans(text) == []


def test_pii_terms_that_disclose(spark, odd, none):
    filler = [(100 + i, f"ordinary people talk about ordinary things number {i}") for i in range(60)]
    secret = [(i, f"patient Quixotington writes from q.ton@mail.org about ordinary things {i}") for i in range(4)]
    docs = spark.createDataFrame(filler + secret, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    text = dict(secret)[1]
    terms = {text[s.begin:s.end] for s in found[1].terms}
    assert "Quixotington" in terms and "ordinary" not in terms
    assert not any(found[d].base or found[d].terms for d, _ in filler)
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "[EMAIL]" in clean[1] and "Quixotington" not in clean[1] and clean[100] == filler[0][1]
    assert pii.find(odd).count() == len(ODD) and pii.find(none).count() == 0
    assert pii.sanitise(odd).count() == len(ODD)


# ----------------------------------------------------------- 4: exact copies
def _exact_expected(rows):
    groups = defaultdict(list)
    content = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for d, t in rows:
        groups[content(t)].append((-len(t or ""), d is None, d or 0, d))
    out = []
    for d, t in rows:
        group = groups[content(t)]
        keep = min(group, key=lambda x: x[:3])[3]
        out.append((d, keep, len(group), d == keep, sha(content(t))))
    return sorted(out, key=str)


def test_exact_groups(spark, odd, none, given):
    assert sorted(map(tuple, queries.op4_exact_dedup(spark, SF).collect()), key=str) == _exact_expected(given)
    assert sorted(map(tuple, exact_groups(odd).collect()), key=str) == _exact_expected(ODD)
    assert exact_groups(none).count() == 0
    kept = drop_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len({re.sub(r"\s", "", t or "") for _, t in ODD})
    assert drop_copies(none).count() == 0


# ------------------------------------------------------------ 5: near copies
def _shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def _near_expected(rows, width):
    sets = [(d, _shingles(t, width)) for d, t in rows]
    label = {d: d for d, _ in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and a is not None and b is not None and 100 * len(s & t) >= 80 * len(s | t):
                a_, b_ = root(a), root(b)
                label[max(a_, b_)] = min(a_, b_)
    return sorted(((d, len(s), root(d) if d is not None else None, d is None or root(d) == d) for d, s in sets),
                  key=str)


def test_near_duplicates(spark, given):
    assert sorted(map(tuple, queries.op5_near_dedup(spark, SF).collect()), key=str) == _near_expected(given, 4)


def test_near_duplicates_odd_rows(odd, none):
    assert sorted(map(tuple, near_duplicates(odd, 4).collect()), key=str) == _near_expected(ODD, 4)
    assert near_duplicates(none).count() == 0
    kept = drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None) == [
        1, 2, 3, 4, 5, 7, 10, 11, 12]


def test_links_between_members_other_than_the_first(spark):
    """Chains and split buckets: links that the least member of a bucket has no part in."""
    base = [f"w{i}" for i in range(100)]
    rows = []
    for k in range(12):  # neighbours in the chain share 0.8 and more, its ends do not
        rows.append((100 - k, " ".join(base[4 * k:] + [f"v{i}" for i in range(4 * k)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, 1).collect()}
    assert got == {r[0]: r[2] for r in _near_expected(rows, 1)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(30, 40), (41, 40), (50, 50)]
    labels = connected_components(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.label for r in labels.collect()}
    assert got == {**{i: 0 for i in range(21)}, 30: 30, 40: 30, 41: 30, 50: 50}


# ------------------------------------------------------------------- 6: chat
CHAT = [(1, 0, "system", "be brief"), (1, 1, "user", "### \\h </turn>\n ###"), (1, 2, "assistant", "\\s ok </turn>"),
        (1, 2, "assistant", "\\s ok </turn>"), (1, None, "user", None), (2, 0, "assistant", ""), (2, 1, None, "x"),
        (None, 0, "a:\n### b", "y"), (None, 1, "assistant", "long " * 4000), (None, 2, "assistant", "z"),
        *[(3, i, "system" if i == 0 else "assistant" if i % 2 else "user", f"turn {i} " * 40) for i in range(700)]]


def _chat_expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append(((turn is not None, turn or 0, role or "", text or ""), role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: t[0])
        out[conv] = ([(r, t) for _, r, t in turns], "".join(t for _, r, t in turns if r == "assistant"))
    return out


def _read_back(conversations):
    got = defaultdict(lambda: ([], []))
    for w in chat.read_back(chat.format_windows(conversations)).orderBy("conv_id", "window").collect():
        got[w.conv_id][0].extend((t.role, t.text) for t in w.turns)
        got[w.conv_id][1].extend(w.targets)
    return {k: (turns, "".join(texts)) for k, (turns, texts) in got.items()}


def test_chat_windows_read_back(spark, odd):
    rows = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(0))
    assert _read_back(rows) == _chat_expected(CHAT)
    windows = chat.format_windows(rows).filter("conv_id = 3").orderBy("window").collect()
    assert len(windows) > 3
    for w in windows:
        assert w.text.startswith("### system:\nturn 0 ")  # the system turn is retained
        assert w.n_tokens <= chat.BUDGET or w.n_turns == 1
    assert all(w.n_repeated > 1 for w in windows[1:])  # and limited history repeated
    assert chat.format_windows(rows.filter("1 = 0")).count() == 0


def test_chat_query(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = _chat_expected(rows + [(-7, 0, "user", said), (-7, 1, "assistant", said)])
    got = {r.conv_id: r for r in queries.op6_chat_format(spark, SF).collect()}
    assert got.keys() == want.keys()
    for conv, (turns, loss) in want.items():
        r = got[conv]
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(loss), sha(loss))
        assert r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in turns))


# ----------------------------------------------------------- 7: token counts
def test_counts_after_edits():
    import random
    counter, rnd = Counter(bpe.load_ranks(queries.RANKS), queries.PATTERN), random.Random(7)
    bits = ["'re", " ", "\n \n", "'", "abc", "12", "日本", "...", ""]
    for text in ["", "x", " " * 900, PROSE * 20, "ab \n" * 700]:
        tree = build(text, counter)
        for _ in range(40):
            begin = rnd.randrange(len(text) + 3)
            end = begin + rnd.choice([0, 1, 3, 400])
            text, again = apply_edit(text, tree, counter, begin, end, "".join(rnd.choices(bits, k=rnd.randrange(4))))
            assert tree.total == len(counter.bpe.encode_ordinary(text)) and sum(tree.sizes) == len(text)
    tree = build(PROSE * 200, counter)
    assert apply_edit(PROSE * 200, tree, counter, 9000, 9003, "x")[1] < 2000


def test_recount(spark, odd, none):
    edits = ("from_json('[{\"begin\":0,\"end\":2,\"replacement\":\"so \"},{},{\"begin\":99999999,\"end\":5,"
             "\"replacement\":\"e\"}]', 'array<struct<begin:long,end:long,replacement:string>>')")
    rows = odd.withColumn("edits", F.expr(f"if(doc_id = 4, null, {edits})"))
    encoder = _tiktoken()
    want = []
    for d, t in ODD:
        after = t or "" if d == 4 else "so " + (t or "")[2:] + "e"
        want.append((d, len(encoder.encode_ordinary(t or "")), len(encoder.encode_ordinary(after)), len(after)))
    got = recount(rows, queries.RANKS, queries.PATTERN).select("doc_id", "n_tokens_before", "n_tokens", "n_chars")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert recount(rows.filter("1 = 0"), queries.RANKS, queries.PATTERN).count() == 0
    docs = table(spark, SF, "documents").collect()
    got = queries.op7_token_counts(spark, SF).collect()
    assert {r.doc_id: r.n_tokens_before for r in got} == {r.doc_id: len(encoder.encode_ordinary(r.text)) for r in docs}


# -------------------------------------------------------- 8: decontamination
def _hits_expected(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if m and item is not None else 0):
            windows[tuple(w[i:i + m])].add(item)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for m in {len(k) for k in windows}:
            for i in range(len(w) - m + 1):
                if (ids := windows.get(tuple(w[i:i + m]))):
                    hit.update(range(i, i + m))
                    found |= ids
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found))))))
    return sorted(out, key=str)


def test_hits_equal_brute_force(spark, given):
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    got = queries.op8_decontamination(spark, SF)
    assert sorted(map(tuple, got.drop("contaminated").collect()), key=str) == _hits_expected(given, items)


def test_hits_odd_rows(spark, odd, none):
    items = [(1, PROSE), (2, None), (3, ""), (4, "naïve"), (5, "The Clocks"), (5, "the clocks"), (None, "a"),
             (6, PROSE[:90]), (7, "x x"), (8, "word7 word8")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256")
    want = _hits_expected(ODD, items)
    for block in (1, 1 << 20):  # an item a block, or all in one
        got = find_hits(odd, benchmark, block_bytes=block).select(*columns).collect()
        assert sorted(map(tuple, got), key=str) == want
        kept = drop_contaminated(odd, benchmark, block_bytes=block)
        assert kept.columns == odd.columns and kept.count() == sum(w[2] == 0 for w in want)
    assert find_hits(odd, benchmark.filter("1 = 0")).filter("n_hit > 0").count() == 0
    assert find_hits(none, benchmark).count() == 0


def test_wu_manber_shifts_pass_no_occurrence():
    import random
    rnd = random.Random(3)
    for _ in range(200):
        item = " ".join(rnd.choices("ab", k=rnd.randrange(1, 14)))
        text = words_of(" ".join(rnd.choices("abc", k=60)))
        spans, _ = WuManber([(1, item)], window=4).search(text)
        pattern = words_of(item)
        m = min(4, len(pattern))
        want = {(i, i + m) for i in range(len(text) - m + 1) for j in range(len(pattern) - m + 1)
                if text[i:i + m] == pattern[j:j + m]}
        assert set(spans) == want


# ------------------------------------------------------------ 9: language ID
def test_language_held_out_accuracy(spark):
    got = queries.op9_language_id(spark, "/root/testdata/sf0.01")
    truth = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    held = got.filter("held_out").join(truth, "doc_id")
    right, n = held.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 200 and right >= 0.97 * n
    assert got.filter("score < 0 or score > 1 or score is null").count() == 0


def test_language_odd_rows(spark, odd, none):
    taught = spark.createDataFrame([(1, "the cat sat on the mat " * 50, "en"), (2, "die katze sitzt auf der matte " * 50, "de"),
                                    (3, None, "fr"), (4, "12 34", "es"), (5, "x", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in identify(odd, taught).collect()}
    assert {d for d, r in got.items() if r.lang_pred == "und"} >= {1, 2, 3}
    assert all(r.lang_pred in ("en", "de", "und") and 0 <= r.score <= 1 for r in got.values())
    assert got[7].lang_pred == "en"
    assert identify(none, taught).count() == 0
    assert {r.lang_pred for r in identify(odd, taught.filter("1 = 0")).collect()} == {"und"}


def test_language_learns_all_languages(spark):
    rng = random.Random(7)
    rows, words = [], {}
    for k in range(70):
        words[k] = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(20)]
        rows += [(10 * k + i, " ".join(rng.choices(words[k], k=60)), f"l{k:02}") for i in range(2)]
    taught = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    asked = [(k, " ".join(rng.choices(words[k], k=30))) for k in range(70)] + [(70, None)]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(asked, "doc_id long, text string"), taught).collect()}
    assert [got[k].lang_pred for k in range(71)] == [f"l{k:02}" for k in range(70)] + ["und"]
    assert all(0 < got[k].score <= 1 for k in range(70)) and got[70].score == 0


def test_one_text_is_not_all_of_a_language(spark):
    rows = [(i, f"long{chr(97 + i)} " * 2000, "x") for i in range(20)]
    sample = training_samples(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 8000)
    assert len(sample["x"]) == 8000 and len({w for w in sample["x"].split() if len(w) == 5}) == 8


# ---------------------------------------------------------------- 10: quality
def test_quality_catches_bad_and_keeps_clean(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op10_quality(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    row = got.agg(F.avg(F.when(good, F.col("accepted").cast("int"))).alias("kept"),
                  F.avg(F.when(F.col("quality") == 0, 1 - F.col("accepted").cast("int"))).alias("dropped")).first()
    assert row.kept > 0.95 and row.dropped > 0.85


def test_quality_clean_text_does_not_outweigh_toxic(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    model, scores = fit(docs, labels)
    rows = scores.withColumn("accepted", F.col("sample_key") >= model.boundary).join(labels, "doc_id").join(docs, "doc_id")
    rejected = [tuple(r) for r in rows.filter("toxic = 1 and not accepted").select("doc_id", "text").collect()]
    clean = rows.filter("toxic = 0 and quality = 1 and accepted").orderBy("doc_id").select("text").collect()
    pad = "\n".join(r[0] for r in clean)[:100_000]
    longer = pa.record_batch([pa.array([r[1] + "\n" + pad for r in rejected])], names=["text"])
    keys = model.keys(model.weights(longer), pa.array([r[0] for r in rejected]))
    assert len(rejected) > 20
    assert (keys < model.boundary).mean() > 0.6


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(7, 1, 0), (7, 1, 0), (5, 0, 0), (None, 1, 1), (10, None, 0), (11, 1, None), (77, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    assert classify(odd, labels).count() == len(ODD)
    kept = keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.filter("doc_id = 7").count() == 2
    assert keep_good(odd, labels.filter("1 = 0")).count() == len(ODD)
    assert classify(none, labels).count() == 0 and keep_good(none, labels).count() == 0
