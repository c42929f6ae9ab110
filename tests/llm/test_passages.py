"""Benchmark windows and tokenizer alignment against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from netloom.llm import align, decontam

A_PATH, B_PATH = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def _contaminated(text, items):
    words, hit, ids = _words(text), set(), set()
    for item, item_text in items:
        of_item = _words(item_text)
        k = min(10, len(of_item))
        windows = {tuple(of_item[i : i + k]) for i in range(len(of_item) - k + 1)} if k else set()
        for i in range(len(words) - k + 1 if k else 0):
            if tuple(words[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                ids |= {str(item)} if item is not None else set()
    return len(words), len(hit), sorted(ids)


def _benchmark_rows(short):
    rnd = random.Random(3)
    vocabulary = ["the", "of", "a", "é", "É", "x1", "ß", "word", "naïve", "…"] + [f"w{i}" for i in range(20)]

    def prose(n):
        return rnd.choice([" ", "  ", "\n", "-"]).join(rnd.choice(vocabulary) for _ in range(n))

    items = [(i, prose(rnd.randrange(10, 25))) for i in range(12)] + [(7, prose(13)), (None, prose(11)), (20, None), (21, "?!"), (22, "")]
    items += [(23, items[3][1])] * 2 + [(24, "The " * 14)]
    if short:
        items += [(30, "W7"), (31, "w8 w9"), (32, "É, é ß")]
    docs = []
    for i in range(120):
        parts = [prose(rnd.randrange(30)) for _ in range(3)]
        if i % 3:
            words = (rnd.choice(items)[1] or "").split()
            parts.insert(rnd.randrange(4), rnd.choice([" ", "\t"]).join(words[rnd.randrange(4) :]).upper() if i % 2 else " ".join(words))
        docs.append((i, " ".join(parts)))
    docs += [(500, None), (501, ""), (502, "\x00\x7f {}"), (None, items[2][1]), (None, items[2][1]), (5, items[4][1]), (5, "clean")]
    docs += [(600, "the " * 3000), (601, " ".join(items[5][1].split() * 200))]
    return docs, items


@pytest.mark.parametrize("short,block", [(False, decontam.BLOCK), (True, decontam.BLOCK), (True, 40)])
def test_benchmark_windows_equal_brute_force(spark, short, block):
    docs, items = _benchmark_rows(short)
    frame = spark.createDataFrame([(i, t, "k", 1) for i, t in docs], "doc_id long, text string, key string, window int")
    bench = spark.createDataFrame([(i, t, "w") for i, t in items], "item_id long, text string, words string")
    rows = decontam.contamination(frame, bench, block=block).collect()
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["n_items"], r["contaminated"]) for r in rows)
    want = Counter()
    for i, t in docs:
        n, hit, ids = _contaminated(t, items)
        want[(i, n, hit, tuple(ids), len(ids), hit > 0)] += 1
    assert got == want


def test_no_documents_or_items(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert decontam.contamination(docs.limit(0), items).count() == 0
    assert [tuple(r) for r in decontam.contamination(docs, items.limit(0)).collect()] == [(1, 2, 0, 0, [], False)]


TEXTS = [
    "Hello world", "  two  spaces ", "tab\tand\nline\r\n", "naïve café 日本語 текст", "<|endoftext|> <s></s>", "a▁b", "12345 67.89e-10", "x",
    " ", "", None, "🙂🙂", "don't 'tis I'll", "ﬁ ½   　", "\x00\x01", "word " * 400, "z" * 3000,
]


def _brute(texts):
    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    letters = {c: x for x, c in align._byte_letters().items()}
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    rows, counts = [], Counter()
    for text in texts:
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        spans = []
        for ids, spell in ((x, a_bytes.__getitem__), (y, b_bytes)):
            at, out = 0, []
            for i in ids:
                out.append((at, at := at + len(spell(i)), i))
            spans.append(out)
            if b"".join(map(spell, ids)) != (b" " + text.encode() if text else b""):
                x = y = None
                break
        if not x:
            rows.append((0, 0, [], ""))
            continue
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = [
            "|".join(",".join(str(i) for s, e, i in side if lo <= s and e <= hi) for side in spans) for lo, hi in zip([0, *cuts], cuts)
        ]
        links = [(i, j) for s, e, i in spans[0] for u, v, j in spans[1] if s < v and u < e]
        counts.update(links)
        rows.append((len(x), len(y), links, ";".join(groups)))
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [
        (x, y, groups.count(";") + 1 if x else 0, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(groups.encode()).hexdigest() if x else "")
        for x, y, links, groups in rows
    ]


@pytest.mark.parametrize("most,hot", [(align.COMMON, align.HOT), (20, 2), (0, 0)])
def test_alignment_equals_brute_force(spark, most, hot):
    rnd = random.Random(5)
    texts = TEXTS + [" ".join(rnd.choice(["the", "The", "café", "tion", "unbelievable", "x9", "日本"]) for _ in range(rnd.randrange(1, 40))) for _ in range(30)]
    texts += ["Hello world"] * 20 + [texts[20]] * 5
    rows = [(None if i == 3 else i % 40, t, "k", "m") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, m string").repartition(3)
    got = Counter(tuple(r) for r in align.compare(docs, A_PATH, B_PATH, most, hot).collect())
    assert got == Counter((r[0], *m) for r, m in zip(rows, _brute(texts)))


def test_alignment_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align.compare(docs, A_PATH, B_PATH).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert align.compare(blank, A_PATH, B_PATH).where(F.col("n_a") + F.col("count_sum") == 0).count() == 2
