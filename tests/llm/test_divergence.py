"""The source divergence audit against a plain loop over whole matrices."""

import re
from collections import Counter

import pytest

from broadsheet.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, least, ranks):
    docs = [(t or "", a or "", s or "") for t, a, s in rows]
    in_docs, counts = Counter(), Counter()
    for text, lang, source in docs:
        terms = TERM.findall(text.translate(LOWER))
        in_docs.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    out = []
    for lang in {a for _, a, _ in docs}:
        kept = [t for (a, t), n in in_docs.items() if a == lang and n >= least]
        sources = {s for _, a, s in docs if a == lang}
        whole = {t: sum(counts[lang, s, t] for s in sources) for t in kept}

        def shares(own):
            n = sum(own.values())
            return {t: 1 + 10**9 * (own[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q = shares(whole)
        p = {s: shares({t: counts[lang, s, t] for t in kept}) for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s, t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, ranks)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(items[:most], 1)]
    return sorted(out)


def found(docs, **options):
    rows = divergence.audit(docs, **options).select("lang", "source", "part", "item", "value", "rank")
    return sorted(map(tuple, rows.collect()))


def texts(docs):
    return [(r["text"], r["lang"], r["source"]) for r in docs.select("text", "lang", "source").collect()]


@pytest.mark.parametrize("least, ranks", [(1, 5), (2, 50), (30, 50)])
def test_odd_rows(odd_docs, least, ranks):
    assert found(odd_docs, least_documents=least, ranks=ranks) == plain(texts(odd_docs), least, ranks)


def test_small_tiles(small_docs, monkeypatch):
    """Several buckets and blocks: sources that lack the terms of a tile are in it all the same."""
    monkeypatch.setattr(divergence, "BUCKET", 20)
    monkeypatch.setattr(divergence, "BLOCK", 3)
    assert found(small_docs, least_documents=3) == plain(texts(small_docs), 3, 50)


def test_ties_over_the_last_rank(spark):
    """Many terms of one value across the last rank; terms beyond the first plane of code points."""
    names = ["term" + "xyzw"[i % 4] + chr(97 + i // 4) for i in range(60)] + ["é", "\U00010400", "￿", "z"]
    rows = [(" ".join(names), "en", "a")] * 2 + [("other words " * 9, "en", "b")] * 2 + [(None, "en", "c")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert found(docs, least_documents=2, ranks=50) == plain(rows, 2, 50)


def test_no_documents(no_docs):
    assert found(no_docs) == []
