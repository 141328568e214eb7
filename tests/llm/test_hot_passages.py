"""Repeated strings under hot keys: one passage in a third of all documents, each with other text around it."""

import random

import numpy as np
from test_operators import _repeats_expected

from keyedlake.llm import suffix_dedup
from keyedlake.llm.suffix_dedup import LENGTH, refine, remove_repeats


def test_one_passage_between_different_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", 20)
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other = prose(60), prose(12)
    rows = [(8 * i, f"{prose(8)} {passage if i % 3 == 0 else prose(20)} {prose(8)}{other if i % 7 == 0 else ''}")
            for i in range(240)]
    rows += [(5, rows[0][1]), (5, rows[3][1]), (None, passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted(map(tuple, remove_repeats(df).drop("kept").collect()), key=str) == _repeats_expected(rows)


def test_hot_keys_meet_window_by_window():
    """Runs of hot keys become windows dealt by their own bytes, so no bucket gets a run a document."""
    rnd = random.Random(9)
    passage = rnd.randbytes(300).hex()
    texts = [rnd.randbytes(40).hex() + passage + rnd.randbytes(40).hex() for _ in range(300)]
    import pyarrow as pa

    ids = np.arange(300)
    batch = pa.record_batch([pa.array(ids), pa.array(ids), pa.array(texts)], names=["doc_id", "text_key", "text"])
    import pandas as pd

    announced = pd.concat([b.to_pandas() for b in suffix_dedup._announce(4)([batch])])
    hot = []
    for bucket, rows in announced.groupby("bucket"):
        told = suffix_dedup._shared(4, 100)((bucket,), rows)
        hot += [np.frombuffer(d, "<i8") for d in told[told["dest"] < 0]["docs"]]
    hot = np.sort(np.concatenate(hot))
    assert 1 <= len(hot) <= 60

    class Sent:
        value = hot

    runs = [suffix_dedup.Runs([(0, 0, t.encode())]).start.astype("<u4").tobytes() for t in texts]
    batch = batch.append_column("begin", pa.array(runs, pa.binary()))
    sent = pd.concat([b.to_pandas() for b in suffix_dedup._send(4, 64, Sent)([batch])])
    sizes = [len(suffix_dedup._plain(c)) for c in sent[sent["bucket"] >= 0].groupby("bucket")["content"].sum()]
    assert len(sizes) > 50 and max(sizes) < 20 * np.median(sizes)


def test_colliding_identifiers_are_parted_by_bytes(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_identifiers", lambda data, offsets: np.zeros(len(offsets), np.uint64))
    data = (b"x" * 70 + b"yz" * 40) * 2
    places = np.arange(len(data) - LENGTH + 1)
    bucket = refine(data, places).tolist()
    for i in places:
        for j in places:
            assert (bucket[i] == bucket[j]) == (data[i:i + LENGTH] == data[j:j + LENGTH])


def test_smaller_q_takes_more_rounds(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "Q", 8)
    rnd = random.Random(3)
    data = bytes(rnd.choice(b"ab") for _ in range(3000)) * 2
    places = np.arange(len(data) - LENGTH + 1)
    bucket = refine(data, places)
    names = {}
    for i, b in enumerate(bucket.tolist()):
        assert b < 0 or names.setdefault(b, data[i:i + LENGTH]) == data[i:i + LENGTH]
    assert len(set(names.values())) == len(names) and (bucket >= 0).sum() >= 3000
