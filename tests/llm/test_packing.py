"""Token ids against the tokenizers library, and instruction data under three limits that differ."""

from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tideline.llm import packing
from tideline.llm import queries as Q


def test_ids_as_the_library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.encoder(Q.vocabulary())
    for text in ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y  ", "<|endoftext|", "  <|endoftext|>\n\n z", "", "été  　 🙂\r\n\t", "<|im_start|>"]:
        assert list(encode(text)) == t.encode(text, add_special_tokens=False).ids
    assert 50256 in encode("a <|endoftext|> b")


def test_special_strings_in_documents(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {i: "text <|endoftext|> and more " * i for i in range(20)}
    pieces = defaultdict(list)
    for p in packing.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), Q.vocabulary(), size=64).collect():
        pieces[p.doc_id].append(p)
    for i, text in texts.items():
        got = np.frombuffer(b"".join(bytes(p.ids) for p in sorted(pieces[i], key=lambda p: p.start)), "<u4")
        assert got.tolist() == [*t.encode(text, add_special_tokens=False).ids, 1]


def test_instruction_data(spark):
    """Prompts bear no loss: a sequence may hold more tokens than loss-bearing ones, and the loss limit binds."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r = np.random.default_rng(2)
    say = lambda n: " ".join(r.choice(["alpha", "beta", "gamma", "delta"], n)) if n else ""
    rows = [(i, [(say(int(r.integers(0, 60))), False), (say(int(r.integers(0, 40))), True), (None, True), (say(5), i % 2 == 0)]) for i in range(300)]
    rows += [(300, None), (301, []), (302, [None, ("one", True)]), (303, [(say(900), True)]), (304, [(say(900), False)])]
    df = spark.createDataFrame(rows, "doc_id long, text array<struct<text:string,loss:boolean>>").repartition(2)
    size, segments, limit = 256, 9, 100
    got = packing.pack(df, Q.vocabulary(), size=size, segments=segments, loss_limit=limit).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in got:
        docs[p.doc_id].append(p), sequences[p.sequence_id].append(p)
        assert p.loss_tokens == sum(p.loss_mask) and len(p.loss_mask) == p.length
    for i, turns in rows:
        ids, mask = [], []
        for text, loss in [x for x in turns or [] if x]:
            one = t.encode(text or "", add_special_tokens=False).ids
            ids += one
            mask += [int(loss)] * len(one)
        last = [x for x in turns or [] if x]
        ids, mask = [*ids, 1], [*mask, int(last[-1][1]) if last else 0]
        ps = sorted(docs[i], key=lambda p: p.start)
        assert np.frombuffer(b"".join(bytes(p.ids) for p in ps), "<u4").tolist() == ids and list(b"".join(bytes(p.loss_mask) for p in ps)) == mask
    loss = []
    for ps in sequences.values():
        ps.sort(key=lambda p: p.offset)
        n = [p.length for p in ps]
        assert [p.offset for p in ps] == [0, *np.cumsum(n)[:-1]] and sum(n) <= size and len(ps) <= segments
        loss.append(sum(p.loss_tokens for p in ps))
        assert loss[-1] <= limit
    assert sum(x == limit for x in loss) > 5 and any(sum(p.length for p in ps) > limit for ps in sequences.values())
