"""Mixing against its own rules, packing by round trips."""

import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from corpus_pipeline import pack_sequences
from tokenizers import Tokenizer

from broadsheet.llm import mixing
from broadsheet.llm.mixing import mix_order, mixed, period, quotas, schedule
from broadsheet.llm.packing import fill, pack, packing_plan
from broadsheet.llm.queries import op3_pack_sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")


def slots_of(rows):
    return sorted((base + (b - first) // len(own) * size + own[(b - first) % len(own)], s)
                  for s, first, end, base, size, own in rows for b in range(first, end))


def plain_schedule(blocks, weights, parts):
    """Slot by slot: the released block with the earliest deadline."""
    left, out = dict(blocks), []
    while any(left.values()):
        alive = {s: weights.get(s, 0) for s, n in left.items() if n and weights.get(s, 0) > 0}
        alive = alive or {s: 1.0 for s, n in left.items() if n}
        size = max(parts, 10 * len(alive))
        quota = quotas(alive, size)
        taken, slot = Counter(), 0
        while all(left[s] for s in alive):
            ready = [(-(-(taken[s] + 1) * size // q), -q, s) for s, q in quota.items()
                     if taken[s] * size // q <= slot]
            s = min(ready)[2]
            out.append(s)
            taken[s] += 1
            left[s] -= 1
            slot += 1
            for r, q in quota.items():
                assert abs(taken[r] * size - q * slot) < size
    return out


@pytest.mark.parametrize("blocks, weights, parts", [
    ({"a": 40, "b": 13, "c": 7}, {"a": 5, "b": 3, "c": 2}, 10),
    ({"a": 3, "b": 90, "c": 0, "d": 5}, {"a": 0.6, "b": 0.3, "c": 0.1}, 100),
    ({"a": 70, "b": 50, "c": 60}, {"a": 1 / 3, "b": 1 / 3, "c": 1 / 3}, 64),
])
def test_schedule(blocks, weights, parts):
    got = slots_of(schedule(blocks, weights, parts))
    assert [i for i, _ in got] == list(range(sum(blocks.values())))
    assert [s for _, s in got] == plain_schedule(blocks, weights, parts)


def test_quotas_and_period():
    quota = quotas({"a": 0.7, "b": 0.2999, "c": 0.0001}, 1000)
    assert sum(quota.values()) == 1000 and quota["c"] == 1
    assert sorted(x for own in period(quota).values() for x in own) == list(range(1000))


def test_mix_of_documents(small_docs):
    rows = mix_order(small_docs, block=4).collect()
    ids = defaultdict(list)
    for r in small_docs.collect():
        ids[r["source"]].append(r["doc_id"])
    assert sorted(r["doc_id"] for r in rows) == sorted(i for own in ids.values() for i in own)
    blocks = {f"={s}": -(-len(own) // 4) for s, own in ids.items()}
    expected = plain_schedule(blocks, {f"={s}": len(own) ** 0.5 for s, own in ids.items()}, 1000)
    for r in rows:
        at = sorted(ids[r["source"]]).index(r["doc_id"])
        assert (r["block"], r["place"]) == divmod(at, 4)
        assert expected[r["slot"]] == f"={r['source']}"
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["slot"], r["place"]))]
    whole = mixed(small_docs, block=4)
    assert whole.columns == small_docs.columns
    assert [r["doc_id"] for r in whole.collect()] == order


def test_mix_of_odd_rows(odd_docs, no_docs):
    assert mix_order(odd_docs).count() == odd_docs.count()
    assert mixed(odd_docs, {"a": 0.9, "absent": 0.1}).count() == odd_docs.count()
    assert mix_order(no_docs).count() == mixed(no_docs).count() == 0


def check_packing(docs, rows, capacity=1024):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    sequences, pieces = defaultdict(list), Counter()
    expected = Counter()
    for d in docs.collect():
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        for a in range(0, len(ids), capacity):
            part = ids[a:a + capacity]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            expected[d["doc_id"], a, len(part), crc, len(ids)] += 1
    for r in rows:
        pieces[r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces == expected
    assert sorted(sequences) == list(range(len(sequences)))
    padding = total = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
        total += at
    return padding / max(total, 1)


def test_pack(small_docs):
    rows = pack(small_docs, PATH, with_ids=True).collect()
    assert check_packing(small_docs, rows) < 0.02
    assert all(len(r["ids"]) == r["length"] for r in rows)


def test_pack_odd_rows(spark, odd_docs, no_docs):
    check_packing(odd_docs, pack(odd_docs, PATH).collect())
    assert pack(no_docs, PATH).count() == 0
    texts = ["a  b\n c  d 　x ", "don't  \n\n  it's 12 !! x\ty<|endoftext|> z", " ", " a", "\n",
             "x été Ж", "tabs\t\tand \r\n ends ", "\U0001f600 \U0001f600  \U0001f600"]
    docs = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts * 2)], "doc_id long, text string")
    check_packing(docs, pack(docs, PATH).collect())


def test_plan_uses_every_piece_once():
    counts = Counter(np.random.default_rng(0).integers(1, 1025, 3000).tolist())
    used = defaultdict(list)
    for n, first, end, _, _, _ in packing_plan(counts):
        used[n] += range(first, end)
    assert {n: sorted(x) for n, x in used.items()} == {n: list(range(c)) for n, c in counts.items()}


def test_fill_is_the_closest():
    assert sum(n * m for n, m in fill({700: 1, 300: 1, 200: 2, 24: 1}, 700, 1024).items()) == 1024
    assert fill({512: 1}, 512, 1024) == {512: 1}
    assert fill({600: 3, 400: 1}, 600, 1024) == {600: 1, 400: 1}


def test_added_tokens_as_loaded(spark, tmp_path):
    texts = ["x y<|endoftext|> z", "<|endoftext|><|endoftext|>", "plain words", "a <|endoftext|>", "<|endof",
             "text|> b", "", None, " <|endoftext|>\n c d" * 500, "plain words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    tokenizer = Tokenizer.from_file(PATH)
    expected = Counter()
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for a in range(0, len(ids), 1024):
            crc = zlib.crc32(np.array(ids[a:a + 1024], "<u4").tobytes())
            expected[i, a, crc, len(ids)] += 1
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for rows in (op3_pack_sequences(spark, str(tmp_path)), pack_sequences(spark, read, str(tmp_path))):
        assert Counter((r["doc_id"], r["start"], r["ids_crc32"], r["doc_tokens"]) for r in rows.collect()) == expected


def test_mix_keeps_exact_weights(spark, monkeypatch):
    sizes = {"hot": 7000, **{f"s{i:02}": 700 for i in range(20)}, "rare": 2}
    docs = spark.createDataFrame(
        [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))], "doc_id long, source string")
    weights = {"hot": 1 / 3, **{f"s{i:02}": 2 / 3 / 20 for i in range(20)}, "rare": 0.0001}
    monkeypatch.setattr(mixing, "PIECE", 100)
    monkeypatch.setattr(mixing, "WRITE_SLOTS", 3000)
    order = [r["source"] for r in mix_order(docs, weights, block=1).orderBy("slot").collect()]
    assert Counter(order) == sizes
    total, taken = sum(map(Fraction, weights.values())), Counter()
    share = {s: Fraction(w) / total for s, w in weights.items()}
    for slot, s in enumerate(order, 1):
        taken[s] += 1
        assert abs(taken[s] - share[s] * slot) < 1
        if slot % 97 == 0:
            assert all(abs(taken[r] - share[r] * slot) < 1 for r in share)
        if taken[s] == sizes[s]:
            break
    assert slot > 10_000


def test_mix_in_parts(small_docs):
    ids = Counter(r["source"] for r in small_docs.collect())
    rows = mix_order(small_docs, block=1, parts=64).collect()
    got = [f"={r['source']}" for r in sorted(rows, key=lambda r: r["slot"])]
    weights = {f"={s}": n ** 0.5 for s, n in ids.items()}
    assert got == plain_schedule({f"={s}": n for s, n in ids.items()}, weights, 64)


def test_every_row_has_a_place(spark):
    """50 different rows without an id, 50 with one, and 5 copies: 105 places, 8 in a slot at most."""
    rows = [(None, f"text {i}", "a") for i in range(50)] + [(i, f"text {i}", "a") for i in range(50)]
    rows += [(7, "text 7", "a")] * 5 + [(i, "b", None) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = [(r["slot"], r["place"]) for r in mix_order(docs).collect()]
    assert len(found) == len(set(found)) == 125
    assert max(p for _, p in found) == 7 and len({s for s, _ in found}) == 14 + 3
    assert sorted(map(repr, mixed(docs).collect())) == sorted(map(repr, docs.collect()))


def test_mixed_columns_of_any_name(odd_docs):
    named = odd_docs.selectExpr("*", "1 slot", "2 place", "3 `key`", "4 tie", "5 block", "6 _doc", "7 _order", "8 `row`")
    out = mixed(named)
    assert out.columns == named.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, named.collect()))


def test_ids_of_words_that_polynomials_confuse(spark):
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    swapped = word.translate(str.maketrans("ab", "ba"))
    texts = [word, swapped, f"x {word} y", f"x {swapped} y", word[:1024], swapped[:1024]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    check_packing(docs, pack(docs, PATH).collect())
