"""The rules in plain Python, one document at a time, to compare Spark's results with."""

import math
import re
from collections import Counter

from broadsheet.functions.stopwords import ENGLISH, as_tokens


def tokens(text):
    text = "".join(c.lower() if c.isascii() else " " for c in text or "")
    found = []
    for run in re.findall("[a-z0-9]+", text):
        repeats = max(len(m.group(0)) for m in re.finditer(r"(.)\1*", run))
        digits = sum(c.isdigit() for c in run)
        if len(run) <= 20 and digits <= 4 and repeats <= 3:
            found.append(run)
    return found


class Word:
    """A word under the letter classes of Porter's paper."""

    def __init__(self, letters):
        self.letters = letters

    def consonant(self, i):
        c = self.letters[i]
        if c in "aeiou":
            return False
        return i == 0 or not self.consonant(i - 1) if c == "y" else True

    def measure(self):
        shape = "".join("C" if self.consonant(i) else "V" for i in range(len(self.letters)))
        return len(re.findall("V+C+", shape))

    def has_vowel(self):
        return any(not self.consonant(i) for i in range(len(self.letters)))

    def double_consonant(self):
        w = self.letters
        return len(w) > 1 and w[-1] == w[-2] and self.consonant(len(w) - 1)

    def cvc(self):
        n = len(self.letters)
        return (
            n > 2 and self.consonant(n - 3) and not self.consonant(n - 2)
            and self.consonant(n - 1) and self.letters[-1] not in "wxy"
        )


STEP_2 = """ational ate tional tion enci ence anci ance izer ize abli able alli al entli ent
eli e ousli ous ization ize ation ate ator ate alism al iveness ive fulness ful ousness ous
aliti al iviti ive biliti ble""".split()
STEP_3 = "icate ic ative - alize al iciti ic ical ic ful - ness -".split()
STEP_4 = """al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive
ize""".split()


def stem(word):
    if len(word) <= 2:
        return word
    # 1a
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # 1b
    if word.endswith("eed"):
        if Word(word[:-3]).measure() > 0:
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            rest = word[: -len(suffix)]
            if word.endswith(suffix) and Word(rest).has_vowel():
                word = rest
                if word.endswith(("at", "bl", "iz")):
                    word += "e"
                elif Word(word).double_consonant() and word[-1] not in "lsz":
                    word = word[:-1]
                elif Word(word).measure() == 1 and Word(word).cvc():
                    word += "e"
                break
    # 1c
    if word.endswith("y") and Word(word[:-1]).has_vowel():
        word = word[:-1] + "i"
    # 2 and 3
    for table in (STEP_2, STEP_3):
        pairs = dict(zip(table[::2], table[1::2]))
        for suffix in sorted(pairs, key=len, reverse=True):
            if word.endswith(suffix):
                rest = word[: -len(suffix)]
                if Word(rest).measure() > 0:
                    word = rest + pairs[suffix].replace("-", "")
                break
    # 4
    for suffix in sorted(STEP_4, key=len, reverse=True):
        if word.endswith(suffix):
            rest = word[: -len(suffix)]
            if Word(rest).measure() > 1 and (suffix != "ion" or rest[-1] in "st"):
                word = rest
            break
    # 5
    if word.endswith("e"):
        rest = Word(word[:-1])
        if rest.measure() > 1 or (rest.measure() == 1 and not rest.cvc()):
            word = word[:-1]
    if word.endswith("ll") and Word(word).measure() > 1:
        word = word[:-1]
    return word


STOP = set(as_tokens(ENGLISH))


def terms(text):
    return [stem(token) for token in tokens(text) if token not in STOP]


def dph(tf, corpus_tf, length, avg_length, n_docs):
    if n_docs // corpus_tf == 0:
        return 0.0
    f = tf / length if tf < length else 0.99999
    norm = (1 - f) ** 2 / (tf + 1)
    return norm * (
        tf * math.log2(tf * avg_length / length * (n_docs // corpus_tf))
        + 0.5 * math.log2(2 * math.pi * tf * (1 - f))
    )


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def greedy(ranked, k, min_distance):
    """``ranked``: (doc_id, title) best first."""
    taken = []
    for doc_id, title in ranked:
        if len(taken) == k:
            break
        if all(
            edit_distance(title, other) / max(len(title), len(other)) >= min_distance
            for _, other in taken
        ):
            taken.append((doc_id, title))
    return [doc_id for doc_id, _ in taken]


def index_text(article):
    paragraphs = [
        item.get("content") or "null" if item.get("content") != "" else ""
        for item in article.get("contents") or []
        if item and item.get("subtype") == "paragraph"
    ]
    return " ".join([article["title"], *paragraphs[:5]])


def rank(articles, queries, k=10, min_distance=0.5):
    """{query: [(doc_id, score)]} for distinct queries, by the whole chain of rules."""
    docs = [(a["id"], a["title"], terms(index_text(a))) for a in articles if a.get("title")]
    wanted = {t for q in queries for t in terms(q)}
    corpus_tf = Counter(t for _, _, ts in docs for t in ts if t in wanted)
    n_docs = len(docs)
    avg_length = sum(len(ts) for _, _, ts in docs) / n_docs
    result = {}
    for query in dict.fromkeys(queries):
        query_terms = terms(query)
        scored = []
        for doc_id, title, ts in docs:
            counts = Counter(ts)
            total = sum(
                dph(counts[t], corpus_tf[t], len(ts), avg_length, n_docs)
                for t in query_terms if counts[t]
            )
            if total != 0:
                scored.append((-round(total / len(query_terms), 9), doc_id, title))
        scored.sort()
        scores = {doc_id: -score for score, doc_id, _ in scored}
        kept = greedy([(d, t) for _, d, t in scored], k, min_distance)
        result[query] = [(d, scores[d]) for d in kept]
    return result
