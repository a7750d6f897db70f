"""Lengths from the heads of WAV files, as the standard library reads them."""

import io
import struct
import wave

from pyspark.sql import functions as F

from duologue.operators import assembly
from duologue.sources import clips


def written(seconds, rate=8000, channels=1, width=2):
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(channels)
        f.setsampwidth(width)
        f.setframerate(rate)
        f.writeframes(b"\0" * int(seconds * rate) * channels * width)
    return out.getvalue()


def with_chunk(data):
    """A chunk of odd length before the format."""
    extra = b"LIST" + struct.pack("<I", 3) + b"abc\0"
    return data[:12] + extra + data[12:]


def unfilled(data):
    at = data.index(b"data") + 4
    return data[:at] + b"\xff" * 4 + data[at + 4 :]


def test_heads(spark):
    plain, stereo = written(1.25), written(0.5, 44100, 2, 3)
    files = {
        "plain": (plain, len(plain), 1.25), "stereo": (stereo, len(stereo), 0.5), "chunk": (with_chunk(plain), len(plain) + 12, 1.25),
        "unfilled": (unfilled(plain), len(plain), 1.25), "head": (plain[:44], len(plain), 1.25), "cut": (plain[:30], len(plain), None),
        "other": (b"OggS" + plain[4:], len(plain), None), "empty": (b"", 0, None), "null": (None, None, None), "short": (b"RIFF", 4, None),
    }
    df = spark.createDataFrame([(k, n, bytearray(b) if b is not None else None) for k, (b, n, _) in files.items()], "path string, length long, content binary")
    got = {r.path: r.duration for r in df.select("path", clips.wav_header(F.col("content"), F.col("length"))["duration"].alias("duration")).collect()}
    assert got == {k: d for k, (_, _, d) in files.items()}
    (head,) = df.where("path = 'stereo'").select(clips.wav_header(F.col("content")).alias("h")).collect()
    assert (head.h.sample_rate, head.h.channels, head.h.byte_rate) == (44100, 2, 44100 * 6)


def test_manifest_from_a_folder(spark, tmp_path):
    for name, seconds in (("a", 0.5), ("b", 2.0)):
        (tmp_path / f"{name}.wav").write_bytes(written(seconds))
    files = clips.audio_files(spark, str(tmp_path))
    assert sorted(tuple(r) for r in assembly.manifest_of_files(files).collect()) == [("a.wav", 0.5), ("b.wav", 2.0)]
