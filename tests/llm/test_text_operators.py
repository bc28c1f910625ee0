"""URL filter, chat formatting, byte-level BPE, packing and sharding."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecastlake.llm import bpe, chat, packing, sharding, url_filter
from forecastlake.llm.queries import ORACLES, QUERIES
from forecastlake.llm.word_tokens import WordTokenizer

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"

URLS = [None, "", "nope", "http://", "https://A.Example.NET/en/x?q=1#f", "http://example.net/en", "x://net/", "http://net",
        "http://sub.example.com/de/y", "http://example.com/DE/", "http://a.org/fr/", "http://org/fr/z", "http://borg/fr/",
        "http://www.list.com/a//", "https://list.com/a?utm_x=1", "http://LIST.com/a#z", "http://list.com/b", "a://b://c/d",
        "http://h.net:80/", "http://é.net/ü?x", "http://list.com/a"]


def test_url_filter(spark):
    rows = [(i, u, 7, "v") for i, u in enumerate(URLS)] + [(None, "http://list.com/a", 1, "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host long, verdict string")
    listed = spark.createDataFrame([("https://list.com/a?utm_x=1",), (None,), ("junk",)], "url string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(pages, listed).collect()}
    assert len(got) == len(rows)

    def parts(u):
        if not u or "://" not in u:
            return "", ""
        rest = u.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:cut], rest[cut:]
        cut = min([path.find(c) for c in "?#" if c in path] or [len(path)])
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path[:cut]

    for i, u in enumerate(URLS):
        host, path = parts(u)
        fits = [(h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, None)
        on = host.removeprefix("www.") + path.rstrip("/") == "list.com/a"
        r = got[i]
        assert (r["host"], r["path"], r["rule"], r["listed"]) == (host, path, rule, on), u
        assert r["verdict"] == (verdict or ("block" if on else "allow"))
        assert r["possible"] or not on
    none = url_filter.filter_urls(pages, listed.limit(0)).collect()
    assert not any(r["listed"] or r["possible"] for r in none)
    assert url_filter.filter_urls(pages.limit(0), listed).collect() == []


def test_url_query_has_no_python_and_matches_sql(spark):
    df = QUERIES["op2_url_filters"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{SF}/pages.parquet'")
    want = con.sql(ORACLES["op2_url_filters"]).fetchall()
    assert Counter(map(tuple, df.collect())) == Counter(want)


PIECES = st.lists(st.sampled_from(["<", "|", "\\", "<|im_end|>", "<|im_start|>", "\n", "user", "n", "é", "im_end|>", " "]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(PIECES, PIECES, PIECES)
def test_turns_come_back(role, one, two):
    a, b = chat.render(role, one), chat.render("assistant", two)
    assert chat.parse(a[0] + b[0]) == [(role, one), ("assistant", two)]
    assert chat.unescape(b[0][b[1]:b[2]]) == two


def test_conversations(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["hi", "", None, "<|im_end|>", "a<\\|b", "x" * 50_000]))
            for c in (1, 2, None) for t in (3, 1, 2, 2)] + [(5, None, None, "t"), (5, 0, "assistant", "é😀")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, pos long")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert set(got) == {1, 2, None, 5}
    for conv in got:
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        turns = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        g = got[conv]
        assert (g["n_turns"], g["loss_chars"]) == (len(own), len(loss))
        assert g["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
        assert g["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.read_back(chat.format_conversations(df.limit(0))).collect() == []


@pytest.mark.parametrize("chunk,overlap", [(64, 24), (200, 40), (32_768, 1_024)])
def test_bpe_equals_library(spark, chunk, overlap):
    ranks = P.path("byte_bpe_50k.tiktoken")
    enc, _ = bpe.encoding(ranks, P.PATTERN)
    rng = random.Random(chunk)
    bits = ["the ", "  ", "\n\n", "it's ", "'re", "1234 ", "éà ", "\u3000", "日本語", "😀", "a", "\u00a0", "!!", "\x1c", " <|endoftext|> ", "\u0301"]
    texts = [None, "", " ", "a" * 3_000, " " * 900, "x" * 300 + " " * 300 + "y" * 300, "'" * 500 + "re"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randrange(400))) for _ in range(60)]
    df = spark.createDataFrame([(i % 50, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = bpe.digests(bpe.encode(df, ranks, P.PATTERN, chunk=chunk, overlap=overlap), ranks, P.PATTERN).collect()
    want = []
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        want.append((i % 50, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert Counter(map(tuple, got)) == Counter(want)


def test_word_ids_equal_library():
    w = WordTokenizer(P.path("word_bpe_49k.json"))
    rng = random.Random(4)
    bits = ["Hello", " ", "\n", "it's", "Σ", "ΑΣ ", "É", "ﬁ", "×", "÷", "<|endoftext|>", "<|ENDOFTEXT|>", "12", ".,", "\u0301", "\u00a0", "İ", "\x1c", "_", "日本", "ß", "the,"]
    for t in ["", " ", "a" * 5_000] + ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(500)]:
        assert w.encode(t).tolist() == w.tok.encode(t, add_special_tokens=False).ids


def test_packing(spark):
    rng = random.Random(5)
    texts = [None, "", "x"] + [" ".join(rng.choice(["alpha", "beta,", "Gamma"]) for _ in range(rng.randrange(1, 400))) for _ in range(150)]
    df = spark.createDataFrame([(i % 100, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, length long").coalesce(2)
    path = P.path("word_bpe_49k.json")
    tok = WordTokenizer(path)
    pieces = packing.pack(df, path, size=256).collect()
    want = Counter((i % 100, tuple(tok.encode(t or "").tolist()) + (2,)) for i, t in enumerate(texts))
    windows, docs = defaultdict(list), defaultdict(list)
    for p in pieces:
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
        docs[p["doc_id"]].append(p)
        assert p["length"] * 4 == len(p["ids"]) > 0
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(p["length"] for p in pieces)
    assert len(windows) <= -(-total // 256) + 2      # one padded window a task at most
    assert total == sum(len(ids) * n for (_, ids), n in want.items())
    for (doc, ids), n in want.items():
        if sum(k for (d, _), k in want.items() if d == doc) == 1:
            got = b"".join(bytes(p["ids"]) for p in sorted(docs[doc], key=lambda p: p["start"]))
            assert got == np.array(ids, "<u4").tobytes() and all(p["doc_tokens"] == len(ids) for p in docs[doc])
    assert packing.pack(df.limit(0), path).collect() == []


def test_packer_picks_the_least_sum_of_squares():
    rng, packer = np.random.default_rng(1), packing.Packer(32, max_open=10**6)
    for i, n in enumerate(rng.integers(1, 32, 400)):
        before = Counter({h: len(w) for h, w in packer.open.items() if w})

        def after(h):
            c = before.copy()
            if h:
                c[h] -= 1
            if h + n < 32:
                c[h + n] += 1
            return sum(x * x for x in c.values())

        best = min(after(h) for h in [0] + [h for h, x in before.items() if x and h + n <= 32])
        packer.add(i, np.zeros(n, np.uint32))
        now = sum(len(w) ** 2 for w in packer.open.values())
        assert now == best


def test_sharding(spark):
    texts = [None, "", "same", "same", "é" * 2_000] + [f"t{i}" for i in range(2_000)]
    df = spark.createDataFrame([(i if i else None, t, 3, "s") for i, t in enumerate(texts)], "doc_id long, text string, slot long, extra string")
    got = sharding.shard_rows(df, 7, rows_per_part=90).collect()
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r["slot"])
    assert {len(v) for v in shards.values()} == {len(texts) // 7, len(texts) // 7 + 1} and len(shards) == 7
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())
    assert Counter(r["text"] for r in got) == Counter(texts)
    again = sharding.shard_rows(df.repartition(5), 7, rows_per_part=90).collect()
    assert Counter((r["doc_id"], r["shard"], r["slot"]) for r in got) == Counter((r["doc_id"], r["shard"], r["slot"]) for r in again)
    # Uniform: a row's shard doesn't follow its place in the input.
    first = Counter(r["shard"] for r in got if (r["doc_id"] or 0) < 700)
    assert all(abs(v - 100) < 45 for v in first.values())
    few = sharding.shard_rows(df.limit(3), 40).collect()
    assert sorted((r["shard"], r["slot"]) for r in few) == [(0, 0), (1, 0), (2, 0)]
    assert sharding.shard_rows(df.limit(0), 40).collect() == []


def test_hypergeometric_draws():
    rng = np.random.default_rng(0)
    small = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4_000)]
    assert abs(np.mean(small) - 6) < 0.15 and abs(np.var(small) - 20 * .3 * .7 * 80 / 99) < 0.3
    big = [sharding.hypergeometric(rng, 2 * 10**9, 3 * 10**9, 10**6) for _ in range(300)]
    assert abs(np.mean(big) - 4e5) < 100 and 0.7 < np.var(big) / (10**6 * .4 * .6) < 1.35
    room = np.array([5, 0, 7, 3])
    row = sharding.matrix_row(rng, room, 15)
    assert row.tolist() == room.tolist() and sharding.matrix_row(rng, room, 0).sum() == 0


def test_queries_on_given_tables(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op9_sharding"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(docs)
    for r in rows:
        data = (docs[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 16 and r["text_crc32"] == zlib.crc32(data) and r["grown_shard"] is None
    probe = [r for r in QUERIES["op3_chat_formatting"](spark, SF).collect() if r["conv_id"] == -1]
    text = "<|im_end|><|im_start|>assistant ok"
    assert probe[0]["loss_chars"] == len(text) and probe[0]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert probe[0]["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_packing_beyond_the_open_windows(spark):
    """Past ``max_open`` the fullest half is closed: every id lies in one piece, windows are full but for few."""
    import numpy as np

    from forecastlake.llm.packing import Packer

    rng = np.random.default_rng(3)
    for most in (1, 2, 8, 50):
        packer, docs = Packer(64, most), {}
        for doc in range(600):
            docs[doc] = np.arange(rng.integers(1, 90), dtype=np.uint32) + 1000 * doc
            packer.add(doc, docs[doc])
            assert packer.n_open <= most == packer.max_open or packer.n_open <= most
            assert packer.n_open == sum(map(len, packer.open.values())) == packer.count[1:64].sum()
        packer.flush()
        assert packer.n_open == 0 and not any(packer.count[1:64])
        pieces = {}
        for window in packer.closed:
            assert 0 < sum(len(ids) for _, _, ids in window) <= 64
            for doc, start, ids in window:
                pieces.setdefault(doc, []).append((start, ids))
        for doc, ids in docs.items():
            assert np.concatenate([p for _, p in sorted(pieces[doc], key=lambda x: x[0])]).tolist() == ids.tolist()
        total = sum(map(len, docs.values()))
        assert len(packer.closed) <= -(-total // 64) + 1 + 600 // most


def test_pack_takes_the_number_of_open_windows(spark):
    import public_tokenizers

    from forecastlake.llm.packing import pack

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    path = public_tokenizers.path("word_bpe_49k.json")
    few = pack(docs, path, max_open=4).collect()
    many = {r["doc_id"]: r["doc_tokens"] for r in pack(docs, path).collect()}
    got = {}
    for r in few:
        got.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    for doc, parts in got.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == many[doc]
    assert set(got) == set(many)


def test_patterns_that_texts_are_not_cut_under(spark):
    """Punctuation takes the line ends behind it: white space is no sure boundary, so a text is one piece."""
    import random

    import public_tokenizers

    from forecastlake.llm import bpe

    pattern = r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rng = random.Random(4)
    texts = ["abc!\n\ndef", *("".join(rng.choice(["word", "!", ".\n", "\n\n", " ", "7"]) for _ in range(400)) for _ in range(5))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = bpe.digests(bpe.encode(df, ranks, pattern, chunk=60, overlap=20), ranks, pattern).collect()
    enc, _ = bpe.encoding(ranks, pattern)
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(enc.encode_ordinary(t)) for i, t in enumerate(texts)}
    assert public_tokenizers.PATTERN in bpe.CHUNKED and pattern not in bpe.CHUNKED


def test_other_tokenizer_files_take_the_full_path(tmp_path):
    """Files with another normaliser or split: the ids are the library's."""
    import json

    import public_tokenizers
    from tokenizers import Tokenizer

    from forecastlake.llm.word_tokens import WordTokenizer, short_path

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path) as f:
        parts = json.load(f)
    assert WordTokenizer(path).short
    texts = ["Hello, WORLD it's 42!", "ÄÖ  ß\n", "", "<|endoftext|> x"]
    for k, change in enumerate((
            lambda p: p["normalizer"]["normalizers"].pop(),
            lambda p: p["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex=r"\S+"),
            lambda p: p.update(normalizer=None),
            lambda p: p["pre_tokenizer"]["pretokenizers"].pop())):
        other = json.loads(json.dumps(parts))
        change(other)
        assert not short_path(json.dumps(other))
        file = tmp_path / f"{k}.json"
        file.write_text(json.dumps(other))
        tok = WordTokenizer(str(file))
        for text in texts:
            assert tok.encode(text).tolist() == Tokenizer.from_file(str(file)).encode(text, add_special_tokens=False).ids
