import io
import math
import os
import wave

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duolect.functions import arrays, audio, files
from duolect.sinks import export
from duolect.sources import clips as clip_source
from duolect.sources.clips import clip_shapes, decode_clips, list_clips, scan_clips


def direct_resample(samples, rate, target):
    """The defining sum of windowed-sinc interpolation, term by term."""
    cutoff = min(rate, target) * audio.ROLLOFF / rate
    out = np.zeros(math.ceil(samples.size * target / rate))
    at = np.arange(samples.size)
    for i in range(out.size):
        z = (at - i * rate / target) * cutoff
        window = np.where(np.abs(z) < 6, np.cos(np.pi * z / 12) ** 2, 0)
        out[i] = (samples * window * np.sinc(z) * cutoff).sum()
    return out


@settings(max_examples=40, deadline=None)
@given(st.sampled_from([(8000, 16000), (22050, 16000), (44100, 16000), (48000, 16000), (16000, 24000)]),
       st.integers(1, 400), st.integers(0, 9))
def test_resample_equals_its_definition(rates, size, seed):
    samples = np.random.default_rng(seed).normal(size=size)
    got = audio.resample(samples, *rates)
    assert got.size == -(-size * rates[1] // rates[0])
    assert np.allclose(got, direct_resample(samples, *rates), atol=1e-12)


@pytest.mark.parametrize("rate", [8000, 22050, 44100, 48000])
def test_resample_keeps_a_tone(rate):
    tone = np.sin(2 * np.pi * 440 * np.arange(rate) / rate)
    out = audio.resample(tone, rate, 16000)
    spectrum = np.abs(np.fft.rfft(out))
    assert out.size == 16000 and spectrum.argmax() == 440
    assert audio.resample(tone, rate, rate) is tone


def pcm_file(values, width, rate, channels):
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as clip:
        clip.setnchannels(channels)
        clip.setsampwidth(width)
        clip.setframerate(rate)
        if width == 1:
            raw = bytes(v + 128 for v in values)
        else:
            raw = b"".join(int(v).to_bytes(width, "little", signed=True) for v in values)
        clip.writeframes(raw)
    return buffer.getvalue()


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_every_sample_width_is_scaled_to_one(width):
    top = 2 ** (8 * width - 1)
    values = [0, top // 2, -top, top - 1, -1, 1]
    frames, rate = audio.decode_wav(pcm_file(values, width, 8000, 2))
    assert rate == 8000 and frames.shape == (3, 2)
    assert np.array_equal(frames.ravel() * top, values)


def test_wav_round_trip_is_exact_for_16_bit():
    values = np.arange(-32768, 32768, 7)
    frames, rate = audio.decode_wav(audio.encode_wav(values / 32768, 24000))
    assert rate == 24000 and np.array_equal(frames[:, 0] * 32768, values)
    loud, _ = audio.decode_wav(audio.encode_wav(np.array([2.0, -2.0]), 8000))
    assert np.array_equal(loud[:, 0] * 32768, [32767, -32768])


def test_clip_scan_decodes_mixes_and_isolates(spark, scratch):
    stereo = np.stack([np.full(800, 0.5), np.full(800, -0.25)], 1)
    clips = {"a.wav": audio.encode_wav(stereo, 8000), "b c.wav": audio.encode_wav(np.zeros(160), 16000),
             "cut.wav": audio.encode_wav(np.zeros(160), 16000)[:-5], "no.wav": b"text", "skip.txt": b""}
    for name, content in clips.items():
        with open(f"{scratch}/{name}", "wb") as out:
            out.write(content)
    listed = {r.path: r.length for r in list_clips(spark, scratch).collect()}
    assert listed == {f"{scratch}/{n}": len(c) for n, c in clips.items() if n.endswith(".wav")}
    rows = {r.path.rsplit("/")[-1]: r for r in decode_clips(scan_clips(spark, scratch)).collect()}
    assert (rows["a.wav"].channels, rows["a.wav"].source_rate, rows["a.wav"].n_samples) == (2, 8000, 1600)
    assert rows["a.wav"].samples[800] == pytest.approx(0.125, abs=1e-3)
    assert rows["b c.wav"].n_samples == 160 and rows["b c.wav"].error is None
    assert rows["cut.wav"].error == "ValueError('Truncated audio data')"
    assert rows["no.wav"].error_kind in ("Error", "EOFError") and rows["no.wav"].samples is None


def test_cut_names_and_bounds(spark):
    cases = [("x/a.wav", 1.0, 15.0, "x/a_cut_1.0-15.0.wav"), ("a", 0.5, 2.25, "a_cut_0.5-2.25.wav"),
             ("d.x/a", 0.0005, 12345678.0, "d.x/a_cut_0.0005-12345678.0.wav"),
             (".wav", 0.0, 1.0, ".wav_cut_0.0-1.0.wav"), ("a.b.wav", 0.1, 0.3, "a.b_cut_0.1-0.3.wav")]
    df = spark.createDataFrame(cases, "p string, s double, e double, want string")
    for row in df.withColumn("got", arrays.cut_name(F.col("p"), F.col("s"), F.col("e"))).collect():
        assert row.got == row.want
    samples = list(range(10))
    bounds = [(0.0, 1.0), (0.2, 0.5), (0.29, 0.31), (-0.1, 0.5), (0.5, 0.5), (0.6, 0.5), (0.0, 1.1), (-0.05, 0.5)]
    df = spark.createDataFrame([(samples, s, e) for s, e in bounds], "v array<int>, s double, e double")
    rows = df.select("s", "e", arrays.cut_samples(F.col("v"), F.col("s"), F.col("e"), F.lit(10)).alias("cut")).collect()
    for row in rows:
        begin, end = int(row.s * 10), int(row.e * 10)
        fits = begin >= 0 and end <= 10 and begin < end
        assert row.cut == (samples[begin:end] if fits else None)


@pytest.mark.parametrize("kind", ["<f4", "<f8"])
@pytest.mark.parametrize("extensible", [False, True])
def test_float_wav(kind, extensible):
    samples = np.array([[0.0, 1.5], [-0.25, 0.125], [1e-9, -1.0]]).astype(kind)
    width = samples.itemsize
    code = (0xFFFE if extensible else 3).to_bytes(2, "little")
    shape = (2).to_bytes(2, "little") + (8000).to_bytes(4, "little") + (16000 * width).to_bytes(4, "little")
    fmt = code + shape + (2 * width).to_bytes(2, "little") + (8 * width).to_bytes(2, "little")
    if extensible:
        fmt += (22).to_bytes(2, "little") + (8 * width).to_bytes(2, "little") + bytes(4) + (3).to_bytes(2, "little") + bytes(14)
    chunk = lambda name, body: name + len(body).to_bytes(4, "little") + body + b"\0" * (len(body) % 2)
    body = b"WAVE" + chunk(b"fmt ", fmt) + chunk(b"fact", b"abc") + chunk(b"data", samples.tobytes())
    content = b"RIFF" + len(body).to_bytes(4, "little") + body
    got, rate = audio.decode_wav(content)
    assert rate == 8000 and (got == samples.astype(np.float64)).all()
    with pytest.raises(ValueError, match="Truncated"):
        audio.decode_wav(content[:-3])


def test_folders_are_listed_by_tasks(spark, scratch, monkeypatch):
    import os
    want = {}
    for n in range(30):
        folder = f"{scratch}/a{n % 3}/b{n % 5}" if n % 2 else f"{scratch}/a{n % 3}"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/c{n}.wav", "wb") as out:
            out.write(b"x" * n)
        want[f"{folder}/c{n}.wav"] = n
    with open(f"{scratch}/a0/c.wav.txt", "wb") as out:
        out.write(b"no clip")
    monkeypatch.setattr(clip_source, "LISTED_ROWS", 2)
    for root in (scratch, f"file:{scratch}", f"{scratch}/"):
        assert {r.path: r.length for r in list_clips(spark, root).collect()} == want
    assert [r.path for r in list_clips(spark, scratch, "c?.wav").where("length = 4").collect()] == [f"{scratch}/a1/c4.wav"]
    assert {r.path: len(r.content) for r in scan_clips(spark, scratch).collect()} == want


def test_shapes_come_from_headers(spark, scratch):
    stereo = audio.encode_wav(np.zeros((800, 2)), 8000)
    odd = stereo[:12] + b"LIST" + (5).to_bytes(4, "little") + b"notes\0" + stereo[12:]  # a chunk of odd size before the samples
    for name, content in {"a.wav": stereo, "odd.wav": odd, "cut.wav": stereo[:-6], "no.wav": b"text", "empty.wav": b""}.items():
        with open(f"{scratch}/{name}", "wb") as out:
            out.write(content)
    rows = {r.path.rsplit("/")[-1]: r for r in clip_shapes(list_clips(spark, scratch)).collect()}
    for name in ("a.wav", "odd.wav"):
        assert (rows[name].rate, rows[name].channels, rows[name].frames, rows[name].clip_duration_s) == (8000, 2, 800, 0.1)
    assert rows["cut.wav"].error == "ValueError('Truncated audio data')"
    assert rows["no.wav"].error_msg == rows["empty.wav"].error_msg == "Not a WAV file"
    assert all(audio.resampled_size(n, r, 16000) == audio.resample(np.zeros(n), r, 16000).size for n in (0, 1, 777) for r in (8000, 16000, 44100, 22050))


@settings(max_examples=60, deadline=None)
@given(st.sampled_from([(8000, 16000), (22050, 16000), (44100, 16000), (48000, 16000), (16000, 24000), (16000, 16000)]),
       st.lists(st.integers(0, 700), max_size=8), st.integers(0, 9))
def test_resampling_does_not_depend_on_blocks(rates, cuts, seed):
    samples = np.random.default_rng(seed).normal(size=700)
    at = [0, *sorted(cuts), 700]
    parts = list(audio.resample_blocks([samples[a:b] for a, b in zip(at, at[1:])], *rates))
    assert np.allclose(np.concatenate(parts), audio.resample(samples, *rates), rtol=0, atol=1e-12)
    assert audio.resample(samples[:0], *rates).size == 0 == sum(b.size for b in audio.resample_blocks([], *rates))


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_ranges_and_blocks_equal_the_whole(width, monkeypatch):
    values = np.random.default_rng(width).integers(-2 ** (8 * width - 1), 2 ** (8 * width - 1), 2 * 501)
    content = pcm_file(values, width, 44100, 2)
    whole, _ = audio.decode_wav(content)
    monkeypatch.setattr(audio, "BLOCK_FRAMES", 64)
    clip = audio.WavClip(io.BytesIO(content))
    assert np.array_equal(np.concatenate(list(clip.blocks())), whole)
    assert np.array_equal(np.concatenate(list(clip.blocks(70, 333))), whole[70:333])
    assert np.array_equal(clip.read(5, 9), whole[5:9])
    direct = audio.resample(whole.mean(axis=1), 44100, 16000).astype(np.float32)
    assert np.allclose(audio.load_mono(content, 16000), direct, rtol=0, atol=1e-7)


def test_a_header_that_claims_too_much_is_refused_before_room_is_made():
    content = bytearray(audio.encode_wav(np.zeros(10), 16000))
    content[40:44] = (0xFFFFFFF0).to_bytes(4, "little")
    with pytest.raises(ValueError, match="Truncated"):
        audio.load_mono(bytes(content), 16000)


class LongFile(io.RawIOBase):
    """A stereo clip of zeros that lies nowhere: only its header is stored."""

    def __init__(self, frames):
        header = io.BytesIO()
        audio.write_wav(header, 44100, 2, frames, [])
        self.header, self.size, self.at = header.getvalue(), 44 + 4 * frames, 0

    def seek(self, at, whence=0):
        self.at = at + (self.at if whence == 1 else self.size if whence == 2 else 0)
        return self.at

    def tell(self):
        return self.at

    def read(self, n=-1):
        n = min(n if n >= 0 else self.size, self.size - self.at)
        found = self.header[self.at:self.at + n]
        self.at += n
        return found + bytes(n - len(found))


def test_memory_does_not_grow_with_the_clip():
    import tracemalloc

    class Sink:
        size = 0

        def write(self, data):
            self.size += len(data)

    peaks = []
    for frames in (3_000_000, 12_000_000):
        clip, out = audio.WavClip(LongFile(frames)), Sink()
        size = audio.resampled_size(frames, 44100, 16000)
        tracemalloc.start()
        audio.write_wav(out, 16000, 1, size, audio.mono_blocks(clip, 16000))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert out.size == 44 + 2 * size
    assert peaks[1] < 1.1 * peaks[0] < 60e6


def test_cuts_and_conversions_from_files(spark, scratch):
    import os
    left, right = np.arange(1000) / 2000, -np.arange(1000) / 4000
    for name, content in {"a b.wav": audio.encode_wav(np.stack([left, right], 1), 1000), "no.wav": b"text",
                          "cut.wav": audio.encode_wav(left, 1000)[:-4]}.items():
        with open(f"{scratch}/{name}", "wb") as out:
            out.write(content)
    cuts = [("a b.wav", 0.1, 0.35), ("a b.wav", 0.9, 1.0), ("a b.wav", 0.9, 1.1), ("a b.wav", None, 1.0), ("no.wav", 0.0, 1.0),
            ("cut.wav", 0.0, 0.1), ("gone.wav", 0.0, 1.0)]
    df = spark.createDataFrame([(f"{scratch}/{n}", s, e) for n, s, e in cuts], "path string, start_s double, end_s double")
    for _ in range(2):  # a second time replaces the files
        rows = sorted((os.path.basename(r.cut_path or ""), r.files, r.error and r.error.split("(")[0]) for r in export.cut_clips(df).collect())
    assert rows == [("", 0, "ValueError"), ("a b_cut_0.1-0.35.wav", 1, None), ("a b_cut_0.9-1.0.wav", 1, None), ("a b_cut_0.9-1.1.wav", 0, "ValueError"),
                    ("cut_cut_0.0-0.1.wav", 0, "ValueError"), ("gone_cut_0.0-1.0.wav", 0, "FileNotFoundError"), ("no_cut_0.0-1.0.wav", 0, "ValueError")]
    whole, _ = audio.decode_wav(open(f"{scratch}/a b.wav", "rb").read())
    got, rate = audio.decode_wav(open(f"{scratch}/a b_cut_0.1-0.35.wav", "rb").read())
    assert rate == 1000 and np.array_equal(got, whole[100:350])
    both = spark.createDataFrame([(f"{scratch}/{n}", f"{scratch}/new/x/{n}") for n in ("a b.wav", "no.wav", "cut.wav")], "path string, out_path string")
    made = {os.path.basename(r.out_path): (r.n_samples, r.error is None) for r in export.convert_clips(both, 1500).collect()}
    assert made == {"a b.wav": (1500, True), "no.wav": (None, False), "cut.wav": (None, False)}
    assert os.listdir(f"{scratch}/new/x") == ["a b.wav"]
    assert not [n for n in os.listdir(scratch) if n.startswith(".")]
    got, rate = audio.decode_wav(open(f"{scratch}/new/x/a b.wav", "rb").read())
    assert rate == 1500 and np.abs(got[:, 0] - audio.resample(whole.mean(axis=1), 1000, 1500)).max() <= 0.501 / 32768


def test_a_local_folder_is_listed_entry_by_entry(scratch, monkeypatch):
    for i in range(25):
        with open(f"{scratch}/{i}.wav", "wb") as file:
            file.write(b"x" * i)
    os.mkdir(f"{scratch}/deeper")
    os.symlink(f"{scratch}/nowhere", f"{scratch}/broken.wav")
    monkeypatch.setattr(clip_source, "LISTED_ROWS", 10)
    monkeypatch.setattr(files.fs, "FileSelector", None)  # whose listing is whole
    batches = list(clip_source._listed(iter([pa.RecordBatch.from_arrays([pa.array([scratch])], ["path"])])))
    assert [b.num_rows for b in batches] == [10, 10, 7]
    found = {tuple(row.values()) for b in batches for row in b.to_pylist()}
    assert found == {(f"{scratch}/{i}.wav", i, False) for i in range(25)} | {
        (f"{scratch}/deeper", 0, True), (f"{scratch}/broken.wav", 0, False)}


def test_encoded_clips_are_rounded_and_bounded():
    wave = np.array([-2.0, -1.0, 0.5 / 32768, 1.5 / 32768, 0.25, 1.0], np.float32)
    kept = wave.copy()
    pcm = np.frombuffer(audio.encode_wav(wave, 24000)[44:], "<i2")
    assert pcm.tolist() == [-32768, -32768, 0, 2, 8192, 32767] and (wave == kept).all()
