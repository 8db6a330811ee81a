import hashlib
import json
import os
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import tokens
from llm_data import ODD, clashing, documents

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{tokens.TOKENIZERS}/{tokens.FILE_A}"), reason="no tokenizer files")


def own_byte(c):
    """Byte of a byte-level character, by the rule written out the other way."""
    o = ord(c)
    if 33 <= o <= 126 or 161 <= o <= 172 or 174 <= o <= 255:
        return o
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
    return hidden[o - 256]


@pytest.fixture(scope="module")
def brute():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(f"{tokens.TOKENIZERS}/{tokens.FILE_A}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{tokens.TOKENIZERS}/{tokens.FILE_B}")
    with open(f"{tokens.TOKENIZERS}/{tokens.FILE_A}") as f:
        name = {i: w for w, i in json.load(f)["model"]["vocab"].items()}

    def cut(text):
        """(A ids with their ends, B ids with their ends), or None."""
        if not text:
            return None
        out = []
        for ids, of in ((a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(map(own_byte, name[i]))),
                        (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                         else b.id_to_piece(i).replace("▁", " ").encode())):
            at, ends, whole = 0, [], b""
            for i in ids:
                whole += of(i)
                ends.append((i, len(whole)))
            if whole != b" " + text.encode():
                return None
            out.append(ends)
        return out

    def rows(texts):
        per, pair = [], Counter()
        for t in texts:
            got = cut(t)
            if got is None:
                per.append((0, 0, 0, [], ""))
                continue
            ta, tb = got
            shared = sorted({e for _, e in ta} & {e for _, e in tb})
            groups, lo = [], 0
            for e in shared:
                groups.append(",".join(str(i) for i, x in ta if lo < x <= e) + "|" + ",".join(str(i) for i, x in tb if lo < x <= e))
                lo = e
            links = [(i, j) for e in shared for i, x in ta if x == e for j, y in tb if y == e]
            pair.update(links)
            per.append((len(ta), len(tb), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        best = {}
        for (_, j), n in pair.items():
            best[j] = max(best.get(j, 0), n)
        return [(na, nb, ng, len(ls), sum(pair[x] == best[x[1]] for x in ls), sum(pair[x] for x in ls), d)
                for na, nb, ng, ls, d in per]
    return rows


def shown(df):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.orderBy("doc_id").collect()]


def test_odd_texts(spark, brute, monkeypatch):
    texts = [*[t for t in ODD if t is None or len(t) < 1000], "a ▁b", "▁", "<|endoftext|> <s></s> <unk>", "\x00 x\x1cy", "\U0001F600 \U0001F600",
             "  two  spaces  ", "tab\t\r\n   x", "café café ﬁ", "the cat sat on the mat"] + ["the cat sat"] * 40
    df = clashing(documents(spark, texts)).repartition(3)
    want = brute(texts)
    assert shown(tokens.op12(df)) == want
    monkeypatch.setattr(tokens, "BROADCAST_PAIRS", 0)                  # the shuffled join
    assert shown(tokens.op12(df)) == want
    assert tokens.op12(df.limit(0)).count() == 0
    null = documents(spark, ["a b", "a b"], [None, None])
    assert [r.n_links > 0 for r in tokens.op12(null).collect()] == [True, True]


def test_table(spark, brute):
    df = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000")
    assert shown(tokens.op12(df)) == brute([r.text for r in df.orderBy("doc_id").collect()])


def test_long_text_in_pieces_and_small_batches(monkeypatch):
    code = tokens.coder(tokens.TOKENIZERS)
    assert code.cuttable
    rng = random.Random(3)
    parts = ["word", "it's", "漢字", "12,5", "\n", "  ", "\t", "café", "-", " ", "\x1c", "..."]
    text = " ".join(rng.choice(parts) for _ in range(20_000))
    whole = tokens.align(code, [text, "x"])
    monkeypatch.setattr(tokens, "PIECE", 50)
    small = tokens.align(code, [text, "x"])
    assert all(list(whole[c]) == list(small[c]) for c in whole if c != "links") and whole["links"].equals(small["links"])
    assert len(tokens.pieces(text, 50)) > 100 and tokens.pieces("x" * 200, 50) == ["x" * 200]
    import pyarrow as pa
    cuts = list(tokens.slices(pa.array(["ab", None, "c" * 99, "", "d"]), 10))
    assert cuts[0][0] == 0 and cuts[-1][1] == 5 and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'sT 0 .,\n\té漢▁ \x1ć ")), min_size=1, max_size=60))
def test_cut_is_exact(text):
    code = tokens.coder(tokens.TOKENIZERS)
    parts = tokens.pieces(text, 1)
    assert " ".join(parts) == text
    own = code._listed(tokens.TOKENIZERS)
    a = [i for p in parts for i in code.encode_a([" " + p])[0]]
    b = [i for p in parts for i in code.b.encode(p)]
    assert a == code.encode_a([" " + text])[0] == own([" " + text])[0] and b == code.b.encode(text)


def test_ranked_merges_equal_the_files_own_library():
    code = tokens.coder(tokens.TOKENIZERS)
    own = code._listed(tokens.TOKENIZERS)
    assert "ranked" in code.encode_a.__code__.co_freevars
    texts = [s for o in [*range(0x3000), *range(0xA000, 0xA100), *range(0x1F600, 0x1F650)]
             for c in [chr(o)] for s in (f" a{c}b 1{c}{c}", f"{c}  {c}.{c}")]
    assert code.encode_a(texts) == own(texts)


def test_pair_bound_holds(spark):
    code = tokens.coder(tokens.TOKENIZERS)
    bound = tokens.pair_bound(code)
    assert bound <= tokens.BROADCAST_PAIRS
    rows = tokens.aligned(spark.read.parquet(f"{SF}/documents.parquet"))
    pairs = tokens.pair_counts(rows).collect()
    a, b = code.bytes_a.to_pylist(), code.bytes_b.to_pylist()
    assert 0 < len(pairs) <= bound
    assert all(a[r.a].endswith(b[r.b]) or b[r.b].endswith(a[r.a]) for r in pairs)
