"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names for every operator."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.llm import audio, chat, mixing, packing, passages, quality, repeats, simhash, toxicity
from tideline.llm import queries as Q

LONG = "The long text goes on and on, é and all. " * 60_000  # 2.5 MB


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None, "x", 1), (None, "no id", None, 2), (2, "", "x", 3), (3, LONG, "y", 4), (4, "same row", None, 5), (4, "same row", None, 5), (5, " \t\n", "", 6), (6, "\x00\x01", "z", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, spans int").withColumn("k1", F.lit("clash")).withColumn("id", F.lit(9)).withColumn("media", F.lit("m")).repartition(2)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def test_simhash(odd, none):
    got = {(r.id, r.fingerprint): r.component_id for r in simhash.near_duplicates(odd).collect()}
    assert simhash.near_duplicates(odd).count() == 8 and simhash.near_duplicates(none).count() == 0
    assert got[1, "0" * 16] == got[2, "0" * 16] == got[5, "0" * 16] == 1
    assert all(f == f"{simhash.fingerprint('no id'):016x}" for (i, f) in got if i is None)


def test_hot_buckets_lose_no_link(spark):
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 63, 5, dtype=np.uint64)
    fps = np.unique(np.concatenate([b ^ np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, (120, 3)).astype(np.uint64), axis=1) for b in base]))
    rows = [(int(np.int64(np.uint64(f).view(np.int64))), i) for i, f in enumerate(fps)]
    df = spark.createDataFrame(rows, "fp long, rep long")
    from test_contracts import components

    links = [(a, b) for a in range(len(fps)) for b in range(a) if int(fps[a] ^ fps[b]).bit_count() <= 4]
    want = components(range(len(fps)), links)
    for bucket in (20_000, 10):
        from tideline.llm.common import Stash

        got = {x.node: x.component for x in simhash.fingerprint_components(df, Stash(spark, "t"), bucket=bucket).collect()}
        assert all(got.get(i, i) == want[i] for i in range(len(fps)))


def test_repeats(odd, none):
    got = repeats.remove_repeats(odd).collect()
    assert len(got) == 8 and repeats.remove_repeats(none).count() == 0
    by = {r.row.spans: r for r in got}
    assert by[4].n_removed == by[4].n_bytes == len(LONG.encode()) and by[4].n_spans == 1 and bytes(by[1].kept) == b""
    assert by[2].row.doc_id is None and bytes(by[2].kept) == b"no id"


def test_passages(odd, none):
    got = passages.passages(odd).collect()
    assert {r.id for r in got} == {3} and passages.passages(none).count() == 0


def test_packing(odd, none):
    got = packing.pack(odd, Q.vocabulary()).collect()
    assert packing.pack(none, Q.vocabulary()).count() == 0
    assert len({(r.sequence_id >> 40, r.row_in_task) for r in got}) == 8
    assert all(r.length == r.doc_tokens == 1 for r in got if r.doc_id in (1, 2))


def test_scores(odd, none, spark):
    labels = spark.createDataFrame([(3, 1), (4, 0), (None, 1), (5, None), (77, 1)], "doc_id long, label int")
    model = toxicity.fit(odd.select("doc_id", "text"), labels)
    for got in (toxicity.score(odd, model).collect(), quality.judge(odd, labels).collect()):
        assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(none, model).count() == 0 and quality.judge(none, labels).count() == 0


def test_mixing(odd, none, spark):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (None, 1, 1), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = mixing.mix(odd, labels).collect()
    assert len(got) == 8 and all(r.rate >= 0 and abs(sum(r.p) - 1) < 1e-6 for r in got)
    assert mixing.mix(none, labels).count() == 0


def test_audio(odd, none):
    wav = audio.with_wav(odd.select("doc_id", F.col("text").cast("binary").alias("payload"), "media"), "payload", "wav")
    got = audio.audio_features(wav, "doc_id", "wav").collect()
    assert len(got) == 8 and audio.audio_features(wav.where("false"), "doc_id", "wav").count() == 0
    by = {r.id: r for r in got}
    assert by[1].media is None and by[1].tensors is None
    t = pa.ipc.open_stream(bytes(by[3].tensors)).read_all()
    assert t.schema.field("log_mel").type == audio.TENSOR and sum(t.column("frames").to_pylist()) > 10_000
    assert t.column("start_s").to_pylist()[1] == pytest.approx(audio.PATCH * audio.HOP_S)
    assert len(pa.ipc.open_stream(bytes(by[2].tensors)).read_all()) == 1
    back = {r.doc_id: r.b for r in wav.select("doc_id", audio.samples(F.col("wav")).alias("b")).collect()}
    assert bytes(back[3]) == LONG.encode() and bytes(back[6]) == b"\x00\x01"


def test_resampler_keeps_a_tone():
    t = np.arange(16_000)
    x = np.sin(2 * np.pi * 440 * t / 16_000).astype(np.float32)
    y = audio.resample(x, 0, 12_000)
    spectrum = np.abs(np.fft.rfft(y[2000:8000] * np.hanning(6000)))
    assert abs(spectrum.argmax() * 12_000 / 6000 - 440) < 3 and 0.8 < np.abs(y[2000:8000]).max() < 1.2
    assert np.array_equal(np.concatenate([audio.resample(x, 0, 5000), audio.resample(x, 5000, 12_000)]), y)


def test_segments():
    e = np.array([0, 0, 2, 0.5, 0.5, -1, 0, 3, -2, 0.5, 0])
    assert audio.segments(e) == [(2, 5), (7, 8)]


def test_chat(spark):
    rows = [(1, 0, "user", "hi <|im_end|> \\ <\\|x|>"), (1, 1, "assistant", None), (2, 0, "user", "hi <|im_end|> \\ <\\|x|>"), (2, 1, "assistant", "so"), (3, None, None, ""), (None, 1, "user", "x"), (2, 1, "assistant", "so"), (4, 0, "a\nb\\n<|r|>", "t\n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node_id", F.lit(1)).withColumn("key", F.lit("clash"))
    nodes, members = chat.prefix_tree(df)
    back = {r.conv_id: r for r in chat.read_back(nodes, members).collect()}
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    for c, ts in want.items():
        assert [(x.role, x.text) for x in back[c].turns] == [(r, x) for _, r, x in sorted(ts)]
    assert back[2].loss_texts == ["so", "so"] and back[1].loss_texts == []
    ns = {n.node_id: n for n in nodes.collect()}
    assert sum(n.length for n in ns.values()) < sum(len(r.formatted) for r in back.values())  # the shared turn once
    stream = "".join(n.text for n in sorted(ns.values(), key=lambda n: n.offset))
    for n in ns.values():
        assert stream[n.offset : n.offset + n.length] == n.text
        before, p = [], n
        while p.parent_id:
            p = ns[p.parent_id]
            before.insert(0, p.text)
        assert "".join(stream[a.start : a.end] for a in n.ancestors) == "".join(before) and n.position == len("".join(before))
        assert not n.parent_id or ns[n.parent_id].offset < n.offset
    empty = chat.prefix_tree(df.where("false"))
    assert chat.read_back(*empty).count() == 0


def test_log_mel_by_direct_transform():
    """Filterbank energies from a plain resampling sum and a plain discrete Fourier transform."""
    r = np.random.default_rng(3)
    x = r.uniform(-1, 1, 2400).astype(np.float32)
    n, up, down = audio.UP * audio.TAPS, audio.UP, audio.DOWN
    t = np.arange(n) - (n - 1) / 2
    h = np.sinc(t / max(up, down)) * np.hamming(n) * (up / max(up, down))
    wide = np.zeros(len(x) * up)
    wide[::up] = x
    y = np.convolve(wide, h)[::down]
    rate = audio.RATE * up // down
    win, hop = int(audio.WINDOW_S * rate), int(audio.HOP_S * rate)
    got = audio.log_mel(x)
    for f in (0, 1, len(got) // 2):
        frame = y[f * hop : f * hop + win] * np.hanning(win)
        power = np.array([abs(sum(frame * np.exp(-2j * np.pi * k * np.arange(win) / audio.FFT))) ** 2 for k in range(audio.FFT // 2 + 1)])
        mel = lambda v: 2595 * np.log10(1 + v / 700)
        edges = 700 * (10 ** (np.linspace(mel(60.0), mel(rate / 2), audio.MELS + 2) / 2595) - 1)
        freq = np.arange(audio.FFT // 2 + 1) * rate / audio.FFT
        want = []
        for lo, mid, hi in zip(edges, edges[1:], edges[2:]):
            w = np.clip(np.minimum((freq - lo) / (mid - lo), (hi - freq) / (hi - mid)), 0, None)
            want.append(np.log(w @ power + 1e-6))
        assert np.allclose(got[f], want, atol=2e-3)


def test_roles_come_back(spark):
    roles = ["\x00", "\\", "\\n", "a\nb", "\\\n", "\\\\n\n", "<|im_end|>", "<\\|x", "user\x00\\", "", None, "\n", "\\\\"]
    t = spark.createDataFrame([(i, 0, role, f"t{i}<|im_end|>\n") for i, role in enumerate(roles)], "conv_id long, turn int, role string, text string")
    got = {r.conv_id: (r.turns[0].role, r.turns[0].text) for r in chat.read_back(*chat.prefix_tree(t)).collect()}
    assert got == {i: (role or "", f"t{i}<|im_end|>\n") for i, role in enumerate(roles)}
