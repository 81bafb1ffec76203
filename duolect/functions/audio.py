"""Numpy helpers that run inside a task: WAV bytes to samples and back."""

from __future__ import annotations

import io
import math
import struct
import wave
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import BinaryIO

import numpy as np

# The resampler's filter half-width in zero crossings and the
# fraction of the lower Nyquist rate it passes.
ZERO_CROSSINGS = 6
ROLLOFF = 0.99
# Format codes of the WAV header.
FLOAT, EXTENSIBLE = 0x0003, 0xFFFE


# Frames decoded, resampled and written at a time.
BLOCK_FRAMES = 1 << 18


def _float_layout(file: BinaryIO, size: int) -> tuple[int, int, int, int, int] | None:
    """Rate, channels, bytes a sample, first byte and frames of a WAV file of floats; None if it is not one."""
    file.seek(0)
    if file.read(4) != b"RIFF":
        return None
    at, shape = 12, None
    while at + 8 <= size:
        file.seek(at)
        name, length = struct.unpack("<4sI", file.read(8))
        if name == b"fmt " and length >= 16:
            body = file.read(min(length, 26))
            code, channels, rate, _, _, bits = struct.unpack("<HHIIHH", body[:16])
            if code == EXTENSIBLE and len(body) == 26:
                code = int.from_bytes(body[24:], "little")
            if code != FLOAT:
                return None
            shape = channels, rate, bits
        elif name == b"data" and shape is not None:
            channels, rate, bits = shape
            if at + 8 + length > size or length % (channels * bits // 8):
                raise ValueError("Truncated audio data")
            if bits not in (32, 64):
                raise ValueError(f"Unsupported sample width: {bits // 8} bytes")
            return rate, channels, bits // 8, at + 8, length // (channels * bits // 8)
        at += 8 + length + length % 2
    return None


class WavClip:
    """An open WAV file of PCM or floats, of which any range of frames is read by itself."""

    def __init__(self, file: BinaryIO):
        self._file, size = file, file.seek(0, 2)
        floats = _float_layout(file, size)
        self.floats = floats is not None
        if floats is not None:
            self.rate, self.channels, self.width, self._at, self.frames = floats
            return
        file.seek(0)
        clip = self._pcm = wave.open(file, "rb")
        self.rate, self.channels, self.width, self.frames = clip.getframerate(), clip.getnchannels(), clip.getsampwidth(), clip.getnframes()
        if self.frames * self.width * self.channels > size - file.tell():  # before room is made for what is not there
            raise ValueError("Truncated audio data")

    def read(self, begin: int, end: int) -> np.ndarray:
        """Frames ``begin`` up to ``end`` as float64 ``[frame, channel]`` samples; PCM samples lie in [-1, 1)."""
        step = self.width * self.channels
        if self.floats:
            self._file.seek(self._at + begin * step)
            raw = self._file.read((end - begin) * step)
        else:
            self._pcm.setpos(begin)
            raw = self._pcm.readframes(end - begin)
        if len(raw) != (end - begin) * step:
            raise ValueError("Truncated audio data")
        if self.floats:
            samples = np.frombuffer(raw, f"<f{self.width}").astype(np.float64)
        elif self.width == 1:
            samples = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128.0) / 128.0
        elif self.width == 3:
            # place the three bytes in the upper part of an int32, so the sign carries over
            padded = np.zeros((len(raw) // 3, 4), np.uint8)
            padded[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
            samples = padded.view("<i4").ravel() / 2.0**31
        elif self.width in (2, 4):
            samples = np.frombuffer(raw, f"<i{self.width}") / 2.0 ** (8 * self.width - 1)
        else:
            raise ValueError(f"Unsupported sample width: {self.width} bytes")
        return samples.reshape(-1, self.channels)

    def blocks(self, begin: int = 0, end: int | None = None) -> Iterator[np.ndarray]:
        """The frames of a range, ``BLOCK_FRAMES`` at a time."""
        end = self.frames if end is None else end
        for at in range(begin, end, BLOCK_FRAMES):
            yield self.read(at, min(at + BLOCK_FRAMES, end))


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """PCM or float WAV bytes as float64 ``[frame, channel]`` samples, and the rate."""
    clip = WavClip(io.BytesIO(content))
    return clip.read(0, clip.frames), clip.rate


def wav_shape(file: BinaryIO, size: int) -> tuple[int, int, int]:
    """Rate, channels and frames of a WAV file of ``size`` bytes, from its chunk headers alone:
    the samples are not read. A file that is none, or whose samples are cut off, is a ValueError."""
    if file.read(12)[:4] != b"RIFF":
        raise ValueError("Not a WAV file")
    at, shape = 12, None
    while at + 8 <= size:
        file.seek(at)
        name, length = struct.unpack("<4sI", file.read(8))
        if name == b"fmt ":
            _, channels, rate, _, step = struct.unpack("<HHIIH", file.read(14))
            shape = rate, channels, step
        elif name == b"data" and shape is not None:
            if at + 8 + length > size or not shape[2] or length % shape[2]:
                raise ValueError("Truncated audio data")
            return shape[0], shape[1], length // shape[2]
        at += 8 + length + length % 2
    raise ValueError("No audio data")


def resampled_size(frames: int, rate: int, target: int) -> int:
    """How many samples ``resample`` makes of so many."""
    divisor = math.gcd(rate, target)
    return frames if rate == target else -(-frames * (target // divisor) // (rate // divisor))


def write_wav(file: BinaryIO, rate: int, channels: int, frames: int, blocks: Iterable[np.ndarray]) -> None:
    """So many frames of floats, given block by block, as a 16-bit PCM WAV file. The header comes
    first and is not touched again, so ``file`` may be a stream."""
    size = 2 * channels * frames
    file.write(struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + size, b"WAVE", b"fmt ", 16, 1, channels, rate,
                           2 * channels * rate, 2 * channels, 16, b"data", size))
    for block in blocks:
        scaled = np.asarray(block) * 32768.0
        np.clip(np.rint(scaled, out=scaled), -32768, 32767, out=scaled)
        file.write(scaled.astype("<i2").tobytes())


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    """Float samples, ``[frame]`` or ``[frame, channel]``, as 16-bit PCM WAV bytes."""
    frames = np.atleast_2d(np.asarray(samples).T).T
    buffer = io.BytesIO()
    write_wav(buffer, rate, frames.shape[1], frames.shape[0], [frames])
    return buffer.getvalue()


# Frames (of as many output samples as there are phases) up to which all are summed at once.
FEW_FRAMES = 8


def mono(frames: np.ndarray) -> np.ndarray:
    return frames.mean(axis=1)


@lru_cache(maxsize=32)
def _phase_filters(old: int, new: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each of ``new`` output phases: the first input sample it reads, relative
    to the frame start, and its Hann-windowed sinc taps."""
    cutoff = min(old, new) * ROLLOFF / old
    reach = math.ceil(ZERO_CROSSINGS / cutoff)
    centre = np.arange(new) * old / new
    first = np.floor(centre).astype(np.int64) - reach
    distance = (first[:, None] + np.arange(2 * reach + 2)) - centre[:, None]
    x = distance * cutoff
    window = np.where(np.abs(x) < ZERO_CROSSINGS, np.cos(np.pi * x / (2 * ZERO_CROSSINGS)) ** 2, 0.0)
    return first, np.sinc(x) * window * cutoff, reach


def _filtered(inputs: np.ndarray, frames: int, count: int, old: int, new: int) -> np.ndarray:
    """The first ``count`` output samples of so many frames; ``inputs`` begin a filter's reach before the first."""
    first, taps, reach = _phase_filters(old, new)
    begin, width = first + reach, taps.shape[1]
    if frames < FEW_FRAMES:  # a call for each phase would cost more than the sums
        at = np.arange(count)
        windows = inputs[(begin[at % new] + at // new * old)[:, None] + np.arange(width)]
        return np.einsum("ij,ij->i", windows, taps[at % new])
    out = np.empty((frames, new))
    for phase in range(new):
        windows = np.lib.stride_tricks.sliding_window_view(inputs[begin[phase]:], width)
        out[:, phase] = windows[::old][:frames] @ taps[phase]
    return out.ravel()[:count]


def resample_blocks(blocks: Iterable[np.ndarray], rate: int, target: int) -> Iterator[np.ndarray]:
    """Band-limited rate change of 1-D samples that come block by block.

    What a filter still needs of the samples before is carried from block to block, so
    the result does not depend on how they are cut, and only two blocks are held at a time.
    """
    if rate == target:
        yield from blocks
        return
    divisor = math.gcd(rate, target)
    old, new = rate // divisor, target // divisor
    reach = _phase_filters(old, new)[2]
    held, seen, made = np.zeros(reach), 0, 0
    coming = iter(blocks)
    block = next(coming, None)
    while block is not None:
        following = next(coming, None)
        held, seen = np.concatenate([held, block]), seen + block.size
        if following is None:
            count = -(-seen * new // old) - made
            frames = -(-count // new)
            held = np.concatenate([held, np.zeros(frames * old + old + 2 * reach + 2 - held.size)])
        else:
            frames = max(0, (held.size - 2 * reach - 1) // old)  # those whose filters lie within
            count = frames * new
        if count:
            yield _filtered(held, frames, count, old, new)
        held, made, block = held[frames * old:], made + count, following


def resample(samples: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Band-limited rate change of 1-D samples; the same rate passes through."""
    return samples if rate == target else next(resample_blocks([samples], rate, target), np.zeros(0))


def mono_blocks(clip: WavClip, target: int) -> Iterator[np.ndarray]:
    """A clip's samples at ``target`` Hz, its channels averaged, block by block."""
    return resample_blocks((mono(block) for block in clip.blocks()), clip.rate, target)


def load_mono(clip: WavClip | bytes, target: int) -> np.ndarray:
    """Decode, average the channels and bring to ``target`` Hz, as float32. Beside the result
    only blocks of the clip are held."""
    clip = WavClip(io.BytesIO(clip)) if isinstance(clip, bytes) else clip
    samples, at = np.empty(resampled_size(clip.frames, clip.rate, target), np.float32), 0
    for block in mono_blocks(clip, target):
        samples[at:at + block.size] = block
        at += block.size
    return samples
