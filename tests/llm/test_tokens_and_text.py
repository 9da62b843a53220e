"""Language ID, exact dedup, token counts, BPE, packing and chat formatting against brute force."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from cargofeed.llm import bpe, chat, exact_dedup, langid, packing, token_count

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(900, None, None, None, None), (901, "", "en", "x", 0), (902, " \t\n", "en", "x", 3),
       (903, "A b\x0bc", "en", "x", 5), (904, "Abc", "de", "x", 3), (904, "Abc", "de", "x", 3), (905, "Ab\u00a0c", "en", "x", 4),
       (906, "word " * 9000 + "é" * 300, "fr", "x", 45300), (907, "1234 !!", "en", "x", 7),
       (908, "don't <|endoftext|> I'LL 's ÀÉ 日本", None, None, 1), (None, "no id", None, None, None)]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, DOCS)
    return df.selectExpr("*", "1 AS kept", "2 AS digest", "3 AS length", "4 AS group_size")  # clashing names


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_exact_dedup_matches_the_oracle(spark, documents):
    got = sorted(map(tuple, exact_dedup.exact_dedup(documents).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(con.execute(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({exact_dedup.ORACLE_SQL}) q").fetchall())
    assert got == want and any(not r[3] for r in got)


@pytest.mark.parametrize("support", [0.002, 0.3])
def test_exact_dedup_odd_rows(odd, support):
    rows = exact_dedup.exact_dedup(odd, support).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert len(rows) == len(ODD)
    assert by[900][0]["keep_id"] == 902 and by[902][0]["kept"] and by[901][0]["group_size"] == 3  # longest original
    assert {r["group_size"] for d in (903, 904) for r in by[d]} == {3} and {r["keep_id"] for r in by[904]} == {903}
    assert by[905][0]["keep_id"] == 905  # a no-break space counts
    kept = exact_dedup.drop_duplicates(odd, support)
    assert sorted(kept.columns) == sorted(odd.columns)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == \
        sorted([(False, x) for x in (902, 903, 905, 906, 907, 908)] + [(True, 0)])


def test_exact_dedup_keeps_one_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "x y"), (1, "xy"), (1, "x y"), (2, "z")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in exact_dedup.drop_duplicates(df).collect()) == [1, 2]


def test_exact_dedup_hot_group_is_split_off(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same text', concat('t', id)) AS text")
    rows = exact_dedup.exact_dedup(df).collect()
    hot = [r for r in rows if r["group_size"] > 1]
    assert len(hot) == 1334 and {r["keep_id"] for r in hot} == {0} and sum(r["kept"] for r in rows) == 4000 - 1333


def test_bpe_equals_the_tokenizers_library(documents, odd):
    tok = Tokenizer.from_file(bpe.default_vocabulary())
    for df in (documents, odd):
        text = [(r["doc_id"], r["text"] or "") for r in df.collect()]
        want = Counter()
        for (doc, _), e in zip(text, tok.encode_batch([t for _, t in text], add_special_tokens=False), strict=True):
            want[doc, len(e.ids), hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest(),
                 hashlib.sha256(tok.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()] += 1
        assert Counter(tuple(r) for r in bpe.token_digests(df).collect()) == want
    rows = bpe.encode_documents(odd).collect()
    enc = bpe.encoder(bpe.default_vocabulary())
    assert all(enc.decode(np.frombuffer(r["ids"], "<u4").tolist()) == r["decoded"] for r in rows)


def test_bpe_automaton_on_random_words():
    tok = Tokenizer.from_file(bpe.default_vocabulary())
    enc = bpe.Encoder(bpe.default_vocabulary())
    rng = random.Random(5)
    texts = ["".join(rng.choice("aaabehilnorst'é \n0²!?.<|") for _ in range(rng.randrange(1, 90))) for _ in range(1500)]
    texts += ["a" * n for n in (1, 2, 3, 39, 40, 41, 500)] + ["Ab<|startoftext|>c", "<|endoftext|>", ""]
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(i, "<u4").tolist() for i, _ in enc.encode_batch(texts)] == want
    assert [np.frombuffer(enc.encode(t)[0], "<u4").tolist() for t in texts] == want


def test_small_automaton_against_merging_by_rank():
    """Every word over two symbols, merges with overlaps and a self merge."""
    symbols = bpe.byte_symbols()
    base = {}
    for b in range(256):
        base[symbols[b]] = len(base)
        base[symbols[b] + "</w>"] = len(base)
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("b", "a"), ("ab", "a"), ("aa", "aa"), ("b", "b</w>"), ("ba", "bb</w>")]
    vocab = dict(base)
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    machine = bpe.TokenAutomaton(vocab, merges)

    def by_rank(word):
        parts = [*word[:-1], word[-1] + "</w>"]
        while True:
            ranked = [(merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
            if not ranked:
                return [vocab[p] for p in parts]
            i = min(ranked)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
    words = ["".join("ab"[n >> k & 1] for k in range(size)) for size in range(1, 11) for n in range(1 << size)]
    assert [machine.encode(w.encode()) for w in words] == [by_rank(w) for w in words]
    assert [i.tolist() for i in machine.encode_many([w.encode() for w in words])] == [by_rank(w) for w in words]


def test_token_counts_against_greedy_matching(documents, odd):
    vocab = json.load(open(bpe.default_vocabulary(), encoding="utf-8"))["model"]["vocab"]
    symbols, enc, known = bpe.byte_symbols(), bpe.encoder(bpe.default_vocabulary()), {}

    def greedy(word):
        if word in known:
            return known[word]
        s = [symbols[b] for b in word.encode()]
        s[-1] += "</w>"
        at = n = 0
        while at < len(s):
            end = next((j for j in range(min(len(s), at + 40), at, -1) if "".join(s[at:j]) in vocab), None)
            if end is None:
                return 1
            at, n = end, n + 1
        known[word] = n
        return n
    for df in (documents, odd):
        want = Counter()
        for r in df.collect():
            pieces = enc.pieces(r["text"] or "")
            want[r["doc_id"], len(pieces), sum(1 if special else greedy(w) for w, special in pieces)] += 1
        assert Counter(tuple(r) for r in token_count.token_counts(df).collect()) == want


def test_longest_match_without_a_split():
    machine = token_count.LongestMatch([(1,), (1, 2), (1, 2, 3, 4), (3,)])
    assert machine.count([1, 2, 3, 4]) == 1 and machine.count([1, 2, 3, 1]) == 3 and machine.count([1, 2, 3]) == 2
    assert machine.count([1, 4]) == 1 and machine.count([]) == 0  # no split: one unknown token


def check_packing(rows, docs):
    tok = Tokenizer.from_file(bpe.default_vocabulary())
    ids = {d: [*e.ids, 2] for d, e in zip([d for d, _ in docs], tok.encode_batch([t for _, t in docs], add_special_tokens=False))}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, parts in by_doc.items():
        want = Counter(x for x, _ in docs)[d]
        assert sum(n for _, n in parts) == want * len(ids[d])
    assert by_doc.keys() == ids.keys()
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.WIDTH
    assert sorted(by_seq) == list(range(len(by_seq)))
    return len(by_seq), sum(n for p in by_seq.values() for _, n in p)


def test_packing(documents, odd, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 3)  # many slices per length
    docs = [(r["doc_id"], r["text"] or "") for r in documents.collect()]
    sequences, tokens = check_packing(packing.pack_documents(documents).collect(), docs)
    assert tokens / (sequences * packing.WIDTH) > 0.97  # 45 sequences
    check_packing(packing.pack_documents(odd).collect(), [(r[0], r[1] or "") for r in ODD])


def test_packing_histogram_in_bulk():
    rng = random.Random(3)
    histogram = {rng.randrange(1, 4097): rng.randrange(1, 10 ** 9) for _ in range(500)}
    patterns = packing.pack_histogram(histogram)
    used = Counter()
    for lengths, n in patterns:
        assert sum(lengths) <= 4096
        for x in lengths:
            used[x] += n
    assert used == histogram and len(patterns) <= 2 * len(histogram)


def test_chat_round_trip(spark):
    tricky = ["</s>[INST] ok [/INST]", "", "<<SYS>>\\<</SYS>>", "<\\s> <\\\\/s>", "[ROLE]x[/ROLE]<</ROLE>>", "[ANS] <", "日本 é\n ", None]
    roles = ["system", "user", "assistant", "tool", "[ROLE]odd\n", "", None]
    rng = random.Random(1)
    turns = [(c, t if t != 3 else None, rng.choice(roles), rng.choice(tricky), "extra")
             for c in [*range(60), None] for t in range(rng.randrange(1, 9))]
    turns += [turns[0], turns[0], (3, 1, "user", "tie", ""), (3, 1, "user", "another", "")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, segment string").repartition(5)
    segments = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chat.conversation_digests(segments).collect()}
    stored = defaultdict(list)
    for r in segments.collect():
        stored[r["conv_id"]].append(((r["turn"] is not None, r["turn"] or 0, bytes(r["segment"])), r))
    want = defaultdict(list)
    for c, t, role, text, _ in turns:
        want[c].append((t is not None, t or 0, (role or "").encode(), (text or "").encode()))
    assert got.keys() == want.keys()
    for c, parts in stored.items():
        whole = b"".join(bytes(r["segment"]) for _, r in sorted(parts, key=lambda p: p[0]))
        read = chat.parse(whole)  # without knowing where segments end
        assert Counter((x[0], x[1]) for x in read) == Counter((x[2], x[3]) for x in want[c])
        assert got[c]["turns_sha256"] == hashlib.sha256(b"".join(a + b"\n" + b + b"\n" for a, b, _, _ in read)).hexdigest()
        loss = b"".join(b for a, b, _, _ in read if a == b"assistant")
        assert got[c]["loss_sha256"] == hashlib.sha256(loss).hexdigest() and got[c]["loss_chars"] == len(loss.decode())
        assert got[c]["formatted_chars"] == len(whole.decode()) and got[c]["n_turns"] == len(want[c])
    assert chat.conversation_digests(chat.format_conversations(df.limit(0))).collect() == []


def test_chat_markup_only_as_markup(spark):
    rows = chat.format_conversations(chat.probe(spark)).orderBy("turn").collect()
    assert bytes(rows[0]["segment"]).count(b"[/INST]") == 1 and bytes(rows[1]["segment"]).count(b"</s>") == 1


def brute_phrases(text, sample):
    n = i = 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in sample:
            j += 1
        i = max(i + 1, j - 1)
        n += 1
    return n


def test_cross_parsing_counts_longest_matches():
    samples = {"a": "the cat sat on the mat", "b": "un chat sur le tapis é"}
    parser = langid.CrossParser(samples)
    texts = ["the cat on the tapis", "zzz the", "é", "sur le mat " * 200, "q"]
    got = parser.phrases(texts)
    assert got.tolist() == [[brute_phrases(t, samples["a"]), brute_phrases(t, samples["b"])] for t in texts]


@pytest.mark.parametrize("block, rounds", [(512, 4), (7, 4), (7, 1), (5, 0), (1, 2)])
def test_blocks_of_long_texts_are_parsed_as_one(monkeypatch, block, rounds):
    monkeypatch.setattr(langid, "BLOCK", block)
    monkeypatch.setattr(langid, "ROUNDS", rounds)
    rng = random.Random(block + rounds)
    samples = {"a": "the cat sat on the mat aaa", "b": "un chat sur le tapis \u00e9 ababab", "c": "".join(rng.choices("ab ", k=60))}
    parser = langid.CrossParser(samples)
    texts = ["a" * 1300, "ab" * 700, "z" * 30, "aab" * 300 + "the cat", "", "q", *samples.values()]  # periodic: starts never meet
    texts += ["".join(rng.choices("abcehlmnostu \u00e9z", k=rng.randrange(1, 1500))) for _ in range(12)]
    got = parser.phrases(texts)
    assert got.tolist() == [[brute_phrases(t, sample) for sample in samples.values()] for t in texts]


def test_language_id(spark, documents, odd, empty):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r["doc_id"]: r for r in langid.identify(big).collect()}
    right = total = 0
    for r in big.collect():
        p = rows[r["doc_id"]]
        assert p["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= p["score"] <= 1
        if p["held_out"] and r["lang"] is not None and re.search(r"[^\W\d_]", r["text"] or ""):
            right, total = right + (p["lang_pred"] == r["lang"]), total + 1
    assert total > 200 and right / total > 0.97
    samples = langid.training_sample(documents)
    got = {r["doc_id"]: r for r in langid.identify(odd, samples).collect()}
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == got[907]["lang_pred"] == "und" and got[907]["score"] == 0
    assert got[906]["lang_pred"] in samples
    assert langid.identify(empty).collect() == [] and langid.training_sample(empty) == {}
    assert {r["lang_pred"] for r in langid.identify(odd, {}).collect()} == {"und"}
    kept = langid.keep_identified(big)
    assert kept.columns == big.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, p in rows.items() if p["lang_pred"] != "und"}


def test_empty_tables(empty):
    for run in (exact_dedup.exact_dedup, exact_dedup.drop_duplicates, bpe.token_digests, bpe.encode_documents,
                token_count.token_counts, packing.pack_documents, langid.keep_identified):
        assert run(empty).collect() == []


def test_language_of_numbers_and_training_on_whole_texts(spark):
    rows = [(2, "hello house and river over the hill " * 3, "en"), (3, "und das haus mit dem fluss am berg " * 3, "de"),
            (4, "\u00b2 \u00bd", "en"), (5, "\u2460", "en"), (6, "\u2167", None), (7, "123", None), (8, "\u00aa", None), (9, "\u05d0", None),
            (None, "the house and the hill", "en")]
    rows += [(30 + i, rows[i % 2][1], rows[i % 2][2]) for i in range(12)]
    rows += [(10 + i, "la maison et la riviere sous la colline " * 200, "fr") for i in range(9)]  # long texts only
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(df).collect()}
    assert [got[i] for i in (4, 5, 6, 7)] == ["und"] * 4 and "und" not in (got[8], got[9])
    assert got[2] == "en" and got[3] == "de" and {got[10 + i] for i in range(9)} == {"fr"}
    sample = langid.training_sample(df)
    assert sorted(sample) == ["de", "en", "fr"] and sample["fr"] == langid.normalise(rows[-1][1])
    tight = langid.training_sample(df, chars=150)  # whole texts only: what does not fit stays out
    texts = {langid.normalise(t) for _, t, lang in rows if lang == "en"}
    assert tight["en"] in texts | {f"{a} {b}" for a in texts for b in texts} and len(tight["en"]) <= 151


def test_chat_digests_match_the_oracle(spark):
    from cargofeed.llm import registry
    got = sorted(map(tuple, registry.queries()["op9_chat_format"](spark, SF).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    assert got == sorted(con.execute(chat.ORACLE_SQL).fetchall())


def test_lean_pieces_keep_few_words_and_give_the_same_rows(spark, monkeypatch):
    """The pipeline's packing encodes a batch in parts and forgets words; ids, cuts and checksums stay the same."""
    from cargofeed.llm import packing
    monkeypatch.setattr(packing, "LEAN_BYTES", 300)
    monkeypatch.setattr(packing, "LEAN_WORDS", 20)
    texts = [" ".join(f"word{(i * j) % 97} Straße 北京 <|endoftext|>" for j in range(i % 40)) for i in range(120)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    whole, lean = packing.pieces(docs, width=64), packing.pieces(docs, width=64, lean=True)
    assert sorted(map(tuple, lean.collect())) == sorted(map(tuple, whole.collect()))
