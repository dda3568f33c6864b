"""Exact dedup, tokenizer alignment and spelling variants against brute force, with the awkward cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from martforge.llm import exact_dedup, spelling_variants, token_alignment
from martforge.llm.common import join_groups

fold = lambda t: (t or "").encode().lower().decode()


def test_join_groups(spark):
    rows = spark.createDataFrame([(i, i % 7 if i % 3 else 0) for i in range(900)], "i long, g long")
    groups = rows.groupBy("g").agg(F.count("*").alias("n"))
    got = {r.i: r.n for r in join_groups(rows, groups, ["g"], "n", least=100).collect()}
    want = collections.Counter(r.g for r in rows.collect())
    assert got == {r.i: want[r.g] for r in rows.collect()}


# 13 exact dedup ----------------------------------------------------------------------------------------------------

def _brute_exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[fold(t)].append(i)
    low = lambda i: (i is not None, i)
    return sorted(((i, max(groups[fold(t)], key=low), len(groups[fold(t)]), hashlib.sha256(fold(t).encode()).hexdigest())
                   for i, t in rows), key=str)


def _check_exact(got, rows):
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == _brute_exact(rows)
    kept = [(r.text_sha256, r.doc_id, r.keep_id) for r in got if r.kept]
    assert len({k[0] for k in kept}) == len(kept) == len({r.text_sha256 for r in got})
    assert all(i == k for _, i, k in kept)


@pytest.mark.parametrize("block", [1, 3, 16, 2048])
def test_exact_dedup_brute_force(spark, block):
    rng = random.Random(block)
    base = ["".join(rng.choices("ab", k=n)) for n in range(1, 40)] + ["abab" * 30, "é" * 50, "İI", "ii"]
    texts = base + [t.upper() for t in base[::2]] + [t + "b" for t in base] + ["x" + t for t in base] + ["", None] * 3 + ["Zz"] * 300
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = exact_dedup.mark(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), block).collect()
    _check_exact(got, rows)


def test_exact_dedup_awkward(docs, empty, spark):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    _check_exact(exact_dedup.mark(docs).collect(), rows)
    assert exact_dedup.mark(empty).count() == 0 and exact_dedup.keep_one(empty).count() == 0
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    want = {(r.keep_id, r.text_sha256) for r in exact_dedup.mark(docs).collect()}
    assert sorted(((r.doc_id, hashlib.sha256(fold(r.text).encode()).hexdigest()) for r in kept.collect()), key=str) == sorted(want, key=str)
    clash = docs.select("doc_id", "text", F.lit(1).alias("keep_id"), F.lit(2).alias("name"), F.lit(3).alias("rid"), F.lit("k").alias("key"))
    assert exact_dedup.mark(clash).count() == len(rows) and exact_dedup.keep_one(clash).columns == clash.columns


def test_names_do_not_rest_on_hashes(spark):
    """All keys at one place, over several partitions: equal keys share a name, different ones never do."""
    rng = random.Random(4)
    rows = [(i, 0, rng.choice([b"a", b"b", b"a\0", b"", b"c" * 40])) for i in range(2000)]
    got = exact_dedup.named(spark.createDataFrame(rows, "rid long, pos int, key binary"), F.lit(7).cast("long")).collect()
    key = {i: k for i, _, k in rows}
    names = collections.defaultdict(set)
    for r in got:
        names[key[r.rid]].add(r.name)
    assert len(got) == 2000 and all(len(n) == 1 for n in names.values())
    assert len(set.union(*names.values())) == len(names)


def test_exact_dedup_query(spark, sf):
    from martforge.llm import queries
    got = queries.op13_exact_dedup(spark, sf)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    _check_exact(got.collect(), [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])


# 12 tokenizer alignment --------------------------------------------------------------------------------------------

A_PATH, B_PATH = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def _brute_alignment(rows):
    """Per (id, text): the contract's columns, token by token."""
    a_tok = tokenizers.Tokenizer.from_file(A_PATH)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    own = {**{i: i for r in ((33, 127), (161, 173), (174, 256)) for i in range(*r)}}
    back = {chr(c): b for b, c in {**own, **{b: 256 + n for n, b in enumerate(x for x in range(256) if x not in own)}}.items()}
    docs, held = [], collections.Counter()
    for i, text in rows:
        text, groups = text or "", []
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        ab = [bytes(back[c] for c in a_tok.id_to_token(x)) for x in a]
        bb = []
        for x in b:
            piece = b_tok.id_to_piece(x)
            bb.append(bytes([int(piece[3:5], 16)]) if b_tok.is_byte(x) else piece.replace("\u2581", " ").encode())
        whole = (" " + text).encode()
        if text and b"".join(ab) == whole == b"".join(bb):
            ia = ib = ea = eb = 0
            group = ([], [])
            while ia < len(a) or ib < len(b):
                if ea <= eb and ia < len(a):
                    group[0].append(a[ia])
                    ea += len(ab[ia])
                    ia += 1
                else:
                    group[1].append(b[ib])
                    eb += len(bb[ib])
                    ib += 1
                if ea == eb:
                    groups.append(group)
                    group = ([], [])
        else:
            a, b = [], []
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        held.update(set(links))
        docs.append((i, a, b, groups, links))
    best = collections.defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for i, a, b, groups, links in docs:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(held[p] == best[p[0]] for p in links),
                    sum(held[p] for p in links), hashlib.sha256(shown.encode()).hexdigest() if shown else ""))
    return sorted(out, key=str)


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
AWKWARD = ["<|endoftext|> and <s>", "a\u2581b", "tab\tand  two   spaces \n\n", "\x00\x01", "ﬁ ligature", "a\u0301", "¼½ ²", "日本語のテキスト",
           "🎉🎉", " lead", "trail ", "<0x41>", "\u200b", "it's we'll THEY'RE", "\u0085x", "1234567 12 3", "İstanbul ßẞ"]


def test_alignment_brute_force(spark, docs, empty, monkeypatch):
    rng = random.Random(12)
    more = [(1000 + i, t) for i, t in enumerate(AWKWARD * 2 + ["".join(rng.choices("abcdeé \n\tñ'12,.", k=n)) for n in range(1, 120)])]
    rows = [(r.doc_id, r.text) for r in docs.collect()] + more
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = token_alignment.measure(frame, A_PATH, B_PATH)
    assert got.columns == ALIGNED and {t for c, t in got.dtypes if c not in ("doc_id", "groups_sha256")} == {"bigint"}
    want = _brute_alignment(rows)
    assert sorted(map(tuple, got.collect()), key=str) == want
    monkeypatch.setattr(token_alignment, "WIDE", 40)  # most pairs join in a shuffle
    assert sorted(map(tuple, token_alignment.measure(frame, A_PATH, B_PATH).collect()), key=str) == want
    assert token_alignment.measure(empty, A_PATH, B_PATH).count() == 0
    clash = docs.select("doc_id", "text", *(F.lit(1).alias(c) for c in ("copies", "tid", "pairs", "n_a", "text_key")))
    assert token_alignment.measure(clash, A_PATH, B_PATH).count() == docs.count()


def test_alignment_of_wide_groups(monkeypatch):
    aligner = token_alignment.Aligner(*token_alignment._files(A_PATH, B_PATH))
    texts = ["some words " * 30 + "日本語" * 40, "aé" * 50 + " x", "", "plain"]
    listed = aligner.align(texts)
    monkeypatch.setattr(token_alignment, "LISTED", 1)
    for x, y in zip(listed, aligner.align(texts)):
        assert list(x) == list(y)


def test_fast_encoder_equals_the_model():
    aligner = token_alignment.Aligner(*token_alignment._files(A_PATH, B_PATH))
    assert aligner.fast is not None
    plain = [chr(c) for c in range(0x250)] + [chr(c) for c in range(0x2010, 0x2028)] + ["\u20ac"]
    rng = random.Random(2)
    texts = [f"a{c}b {c}1 {c}{c} x{c}\n'{c}s" for c in plain] + ["".join(rng.choices(plain, k=60)) for _ in range(300)]
    for t in texts:
        assert token_alignment.PLAIN.fullmatch(t)
        assert aligner.fast.encode_ordinary(" " + t) == aligner.a.encode(" " + t, add_special_tokens=False).ids, t


def test_alignment_query(spark, sf):
    from martforge.llm import queries
    got = queries.op12_token_alignment(spark, sf)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, got.select(ALIGNED).collect()), key=str) == _brute_alignment(rows)


# 11 spelling variants ----------------------------------------------------------------------------------------------

def _edits(word, alphabet):
    """All strings one code point apart."""
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in alphabet}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in alphabet}
    return out - {word}


def _brute_variants(rows):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = fold(run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    alphabet = {c for w in words for c in w}
    near = {w: _edits(w, alphabet) & words.keys() for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


VARIANTS = ["word", "form", "root", "n", "n_near", "form_n"]


def _check_variants(spark, rows):
    got = spelling_variants.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert got.columns == VARIANTS
    want = _brute_variants(rows)
    assert sorted(map(tuple, got.collect())) == want
    return want


def test_variants_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    stems = ["".join(rng.choices("abé", k=rng.randrange(6, 12))) for _ in range(60)] + ["çàéèùôö", "aaaaaaaa", "aaaaaaa", "aaaaaaaaa", "Straße÷x×"]
    pool = []
    for k, s in enumerate(stems):
        pool += [s] * (1 + 300 // (k + 1))
        pool += [rng.choice(sorted(_edits(s, "abcé"))) for _ in range(8)] * 2
    pool += ["abcdefghij"] * 600 + ["abcdefghi"] * 36 + ["abcdefgh"] * 2 + ["short"] * 9
    rng.shuffle(pool)
    rows = [(i, rng.choice([" ", ", ", "\n", "1"]).join(pool[k:k + 40]).title() if i % 3 else " ".join(pool[k:k + 40]))
            for i, k in enumerate(range(0, len(pool), 40))] + [(None, "abcdefghij Abcdefghij"), (9999, None), (9998, "")]
    want = _check_variants(spark, rows)
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] not in (None, r[2]) for r in want)
    monkeypatch.setattr(spelling_variants, "SHARD", 6)  # halves are cut into parts and blocks
    monkeypatch.setattr(spelling_variants, "ASKED", 9)
    monkeypatch.setattr(spelling_variants, "NARROW", 1)
    monkeypatch.setattr(spelling_variants, "HELD", 10)
    _check_variants(spark, rows)


def test_index_searches():
    rng = random.Random(5)
    words = np.array(sorted({"".join(rng.choices("abc", k=rng.randrange(7, 10))) for _ in range(400)} | {"éöüàçñß"}), dtype=object)
    asked = np.array([*words[::3], "zzzzzzzz", "abzabca"], dtype=object)
    half = np.array([len(w) // 2 for w in asked])
    q, w = spelling_variants.Index(words).variants(asked, half)
    want = set()
    for i, a in enumerate(asked):
        h = half[i]
        for j, b in enumerate(words):
            if b.endswith(a[h:]) and b in _edits(a, "abcéöüàçñß") and len(b) >= len(a) and b[:len(b) - len(a) + h] in _edits(a[:h], "abcéöüàçñß"):
                want.add((i, j))
    assert len(want) > 20 and set(zip(q.tolist(), w.tolist())) == want and len(q) == len(want)


def test_variants_awkward(spark, docs, empty, sf):
    assert sorted(map(tuple, spelling_variants.variants(docs).collect())) == _brute_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert spelling_variants.variants(empty).count() == 0
    clash = docs.select("doc_id", "text", *(F.lit(1).alias(c) for c in ("word", "n", "half", "side", "form")))
    assert spelling_variants.variants(clash).count() == spelling_variants.variants(docs).count()
    from martforge.llm import queries
    got = queries.op11_spelling(spark, sf)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, got.select(VARIANTS).collect())) == _brute_variants(rows)
