"""Lossless WebP: a reader of the whole format, a writer, and media columns made of texts.

The reader decodes prefix codes (simple and normal), back-references, the colour cache and groups of prefix codes, and inverts the predictor,
cross-colour, subtract-green and palette transforms. Prefix codes are looked up by as many bits as the longest has, and literals, copies and cache hits are taken one symbol at a time from a bit buffer.

The writer stores one sample a pixel, in green. Where there are 16 colours or fewer the palette transform puts several to a pixel. Repeats become back-references to the last
place with the same five pixels, and symbols are written by length-limited prefix codes made from the image's counts. It has no use for a colour cache: where a pixel is one sample, a hit stands for the same pixel as
the literal and takes no fewer bits.

Cases for texts: null is the empty text; the empty text gives one block of padding; more samples than one image may hold go to further images
behind the first; equal texts give equal bytes; repeated rows and null ids are kept; other columns don't take part.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import table

BLOCK = 576  # bytes of payload, one row of pixels
MOST_ROWS = 1 << 14
#: Pixels that are compared at two places, the fewest and most that one copy takes, and how far back it may lie.
LEAST, SHORTEST, LONGEST, FARTHEST = 4, 8, 4096, (1 << 20) - 120
#: Further bits of a length or distance by its prefix.
MORE = np.maximum((np.arange(40) - 2) >> 1, 0)
LOWEST = np.where(np.arange(40) < 4, np.arange(40), (2 + (np.arange(40) & 1)) << MORE) + 1
MORE_MASK = (1 << MORE) - 1
#: Bytes that are looked up together when reading: few enough for the arrays to stay in the processor's cache. Their bits, and each one's place in its byte.
STRETCH = 1 << 13
PLACES = np.arange(8 * STRETCH + 1)
IN_BYTE = PLACES & 7
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
#: Order in which the lengths of the code for code lengths are written; fixed values.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
#: Near places that short distance codes stand for: by distance, then the smaller horizontal step, right before left.
NEAR = sorted(((dx, dy) for dx in range(-7, 9) for dy in range(8) if dy or dx > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))
CACHE_HASH = 0x1E35A7BD  # fixed value


class Bits:
    """Bits of bytes, lowest first."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def read(self, n: int) -> int:
        if self.at + n > 8 * len(self.data):
            raise ValueError("the image ends too early")
        first = self.at >> 3
        value = int.from_bytes(self.data[first : (self.at + n + 7) >> 3], "little") >> (self.at & 7)
        self.at += n
        return value & ((1 << n) - 1)


class PrefixCode:
    """A canonical prefix code from code lengths by symbol. ``array`` has, for the next ``width`` bits, the symbol * 16 + how many of them it takes."""

    def __init__(self, lengths: np.ndarray):
        used = np.flatnonzero(lengths)
        self.only = int(used[0]) if len(used) == 1 else None if len(used) else 0
        if self.only is not None:
            self.width, self.array = 0, np.array([self.only * 16])
            return
        n = lengths[used].astype(np.int64)
        order = n.argsort(kind="stable")
        n = n[order]
        self.width = int(n[-1])
        spans = 1 << (self.width - n)
        if spans.sum() != 1 << self.width:
            raise ValueError("a prefix code isn't complete")
        # codes in order fill the table from the first bit down; the stream has the first bit lowest
        self.array = np.repeat(used[order] * 16 + n, spans).take(_reversed(self.width))

    @cached_property
    def table(self) -> list[int]:
        return self.array.tolist()


@lru_cache(maxsize=16)
def _reversed(width: int) -> np.ndarray:
    """Numbers of so many bits, their bits turned around."""
    x, out = np.arange(1 << width), np.zeros(1 << width, np.int64)
    for _ in range(width):
        out, x = out << 1 | x & 1, x >> 1
    return out


#: Numbers of 7 bits, turned around.
TURNED = _reversed(7).tolist()


def _small_code(lengths: list[int]) -> list[tuple[int, int, int]]:
    """A code of few symbols and at most 7 bits: symbol, bits and code (first bit lowest), shortest first; a symbol alone takes none."""
    used = sorted((n, s) for s, n in enumerate(lengths) if n)
    if len(used) < 2:
        return [(used[0][1] if used else 0, 0, 0)]
    out, code = [], 0
    for n, s in used:
        out.append((s, n, TURNED[code & 127]))
        code += 128 >> n
    if code != 128:
        raise ValueError("a prefix code isn't complete")
    return out


@lru_cache(maxsize=1024)
def _short_code(size: int, *symbols: int) -> PrefixCode:
    lengths = np.zeros(size, np.int64)
    lengths[list(symbols)] = 1
    return PrefixCode(lengths)


def _read_code(bits: Bits, size: int) -> PrefixCode:
    if bits.read(1):
        two = bits.read(1)
        first = bits.read(8 if bits.read(1) else 1)
        return _short_code(size, first, bits.read(8)) if two else _short_code(size, first)
    data, place = bits.data, (bits.at >> 3) + 32
    buffer, held = int.from_bytes(data[place - 32 : place], "little") >> (bits.at & 7), 256 - (bits.at & 7)
    own, n = [0] * 19, 4 + (buffer & 15)
    buffer >>= 4
    for symbol in LENGTH_ORDER[:n]:
        own[symbol] = buffer & 7
        buffer >>= 3
    held -= 4 + 3 * n
    code = _small_code(own)
    width = code[-1][1]
    mask, table_ = (1 << width) - 1, [0] * (1 << width)
    for s, n, first in code:
        table_[first :: 1 << n] = [16 * s + n] * (1 << (width - n))
    left, n = size, 1
    if buffer & 1:
        more = 2 + 2 * (buffer >> 1 & 7)
        left, n = 2 + (buffer >> 4 & ((1 << more) - 1)), 4 + more
    buffer >>= n
    held -= n
    lengths = bytearray(size)
    at, before = 0, 8
    while at < size and left:
        left -= 1
        if held < 32:
            buffer |= int.from_bytes(data[place : place + 32], "little") << held
            held, place = held + 256, place + 32
        entry = table_[buffer & mask]
        s, n = entry >> 4, entry & 15
        buffer >>= n
        held -= n
        if s < 16:
            lengths[at] = s
            at, before = at + 1, s or before
            continue
        value, least, n = (before, 3, 2) if s == 16 else (0, 3, 3) if s == 17 else (0, 11, 7)
        more = least + (buffer & ((1 << n) - 1))
        buffer >>= n
        held -= n
        if at + more > size:
            raise ValueError("too many code lengths")
        if value:
            lengths[at : at + more] = bytes([value]) * more
        at += more
    bits.at = 8 * place - held
    if bits.at > 8 * len(data):
        raise ValueError("the image ends too early")
    return PrefixCode(np.frombuffer(lengths, np.uint8))


def _read_pixels(bits: Bits, width: int, height: int, main: bool) -> np.ndarray:
    """height x width x (red, green, blue, alpha)."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    groups_at, step, n_groups = None, 0, 1
    if main and bits.read(1):
        step = bits.read(3) + 2
        at = _read_pixels(bits, -(-width >> step), -(-height >> step), False).astype(int)
        groups_at = at[:, :, 0] * 256 + at[:, :, 1]
        n_groups = int(groups_at.max()) + 1
    cache_size = 1 << cache_bits if cache_bits else 0
    groups = [[_read_code(bits, n) for n in (280 + cache_size, 256, 256, 256, 40)] for _ in range(n_groups)]
    if len(groups) == 1 and not cache_bits and not any(code.width for code in groups[0][1:4]):
        return _green(bits, width, width * height, *groups[0]).reshape(height, width, 4)
    out = _symbols(bits, width, width * height, groups, (lambda at: groups_at[at // width >> step, at % width >> step]) if groups_at is not None else None, cache_bits)
    pixels = np.array(out, np.uint32)
    return pixels.view(np.uint8).reshape(height, width, 4)[:, :, [2, 1, 0, 3]] if np.little_endian else np.stack([pixels >> k & 255 for k in (16, 8, 0, 24)], 1).astype(np.uint8).reshape(height, width, 4)


def _green(bits: Bits, width: int, n: int, green: PrefixCode, red: PrefixCode, blue: PrefixCode, alpha: PrefixCode, far: PrefixCode) -> np.ndarray:
    """n pixels that differ in green alone. What would be read at each bit is looked up for all bits at once; one walk then finds where symbols really begin.

    Stretches of STRETCH bytes are looked up at a time, so that the arrays stay small.
    """
    samples, place = bytearray(), bits.at
    near = _near_distances(width)
    greens, mask = green.array, (1 << green.width) - 1
    while len(samples) < n:
        first = place >> 3
        raw = bits.data[first : first + STRETCH + 16]
        m = min(len(raw), STRETCH)
        words = np.ndarray(m + 16, "<i8", raw + bytes(24), 0, (1,)).copy()  # from each byte on, eight bytes
        ends = 8 * m
        entry = greens.take(np.repeat(words[:m], 8) >> IN_BYTE[:ends] & mask, mode="clip")
        one = PLACES[: ends + 1].copy()
        one[:ends] += entry & 15
        copy = (entry >= 256 << 4).nonzero()[0]
        one[copy] += _copy_bits(words, copy, entry[copy], far)
        p, walk = place - 8 * first, []
        if not green.width and green.only < 256:
            walk = np.full(n - len(samples), p)
        else:
            # steps of 1, 2, 4 and 8 symbols; what leads behind the stretch stays at its end
            two = one.take(one, mode="clip")
            four = two.take(two, mode="clip")
            step = four.take(four, mode="clip").item
            while p < ends:
                walk.append(p)
                p = step(p)
            walk = np.array(walk, np.int64)
            for jump in (four, two, one):
                both = np.empty((len(walk), 2), np.int64)
                both[:, 0], both[:, 1] = walk, jump.take(walk, mode="clip")
                walk = both.reshape(-1)
            walk = walk[walk < ends]
        if not len(walk):
            raise ValueError("the image ends too early")
        entry = entry[walk]
        copied = (entry >= 256 << 4).nonzero()[0]
        length, back = _copy(words, walk[copied], entry[copied], far)
        back = np.where(back > 120, back - 120, near[np.minimum(back, 120) - 1])
        # literals lie one behind the other, between copies
        literals, used = (entry >> 4).astype(np.uint8).tobytes(), 0
        for place, k, d in zip(copied.tolist(), length.tolist(), back.tolist(), strict=True):
            a = len(samples) + place - used
            if a >= n:
                break
            if d > a or a + k > n:
                raise ValueError("a back-reference leaves the image")
            samples += literals[used:place]
            if k <= d:
                samples += samples[a - d : a - d + k]
            else:
                samples += (samples[a - d : a] * (k // d + 1))[:k]
            used = place + 1
        rest = min(len(literals) - used, n - len(samples))
        samples += literals[used : used + rest]
        place = 8 * first + int(one[walk[used + rest - 1]])
        if place > 8 * len(bits.data):
            raise ValueError("the image ends too early")
    bits.at = place
    others = red.only | blue.only << 16 | alpha.only << 24
    return (np.frombuffer(samples, np.uint8).astype("<u4") << 8 | np.uint32(others)).view(np.uint8).reshape(n, 4)


@lru_cache(maxsize=8)
def _near_distances(width: int) -> np.ndarray:
    return np.array([max(1, dx + dy * width) for dx, dy in NEAR])


def _copy_bits(words: np.ndarray, at: np.ndarray, entry: np.ndarray, far: PrefixCode) -> np.ndarray:
    """Of copies whose length's prefix begins at these bits and was looked up as entry: the bits that follow that prefix."""
    took = entry & 15
    more = MORE[np.minimum((entry >> 4) - 256, 39)]  # what is no copy is a hit of the cache, and there is none here
    entry = far.array[words[at >> 3] >> ((at & 7) + took + more) & ((1 << far.width) - 1)]
    return more + (entry & 15) + MORE[entry >> 4]


def _copy(words: np.ndarray, at: np.ndarray, entry: np.ndarray, far: PrefixCode) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and codes of distances, of such copies."""

    def number(s: np.ndarray, at: np.ndarray) -> np.ndarray:
        return LOWEST[s] + (words[at >> 3] >> (at & 7) & MORE_MASK[s])

    at = at + (entry & 15)
    s = (entry >> 4) - 256
    length, at = number(s, at), at + MORE[s]
    entry = far.array[words[at >> 3] >> (at & 7) & ((1 << far.width) - 1)]
    return length, number(entry >> 4, at + (entry & 15))


def _symbols(bits: Bits, width: int, n: int, groups: list[list[PrefixCode]], group_at, cache_bits: int) -> list[int]:
    """n pixels as alpha, red, green, blue from the highest byte down."""
    data, out = bits.data, []
    place, held, buffer = bits.at >> 3, 0, 0  # bytes taken, bits in the buffer
    buffer, held, place = data[place] >> (bits.at & 7) if place < len(data) else 0, 8 - (bits.at & 7), place + 1
    cache, cached, shift = [0] * (1 << cache_bits if cache_bits else 0), 0, 32 - cache_bits
    codes = None
    at = 0
    while at < n:
        if codes is None or group_at is not None:
            green, red, blue, alpha, far = codes = groups[group_at(at) if group_at is not None else 0]
            greens, green_mask = green.table, (1 << green.width) - 1
            others = None if red.width or blue.width or alpha.width else alpha.only << 24 | red.only << 16 | blue.only
        if held < 32:
            buffer |= int.from_bytes(data[place : place + 6], "little") << held
            held, place = held + 48, place + 6
        entry = greens[buffer & green_mask]
        took = entry & 15
        buffer >>= took
        held -= took
        s = entry >> 4
        if s < 256:
            if others is not None:
                out.append(others | s << 8)
            else:
                pixel = s << 8
                for code, up in ((red, 16), (blue, 0), (alpha, 24)):
                    if held < 32:
                        buffer |= int.from_bytes(data[place : place + 6], "little") << held
                        held, place = held + 48, place + 6
                    entry = code.table[buffer & ((1 << code.width) - 1)]
                    buffer >>= entry & 15
                    held -= entry & 15
                    pixel |= entry >> 4 << up
                out.append(pixel)
            at += 1
        elif s < 280:
            s -= 256
            more = (s - 2) >> 1 if s > 3 else 0
            length = s + 1 if s < 4 else ((2 + (s & 1)) << more) + (buffer & ((1 << more) - 1)) + 1
            buffer >>= more
            held -= more
            if held < 48:
                buffer |= int.from_bytes(data[place : place + 6], "little") << held
                held, place = held + 48, place + 6
            entry = far.table[buffer & ((1 << far.width) - 1)]
            buffer >>= entry & 15
            held -= entry & 15
            s = entry >> 4
            more = (s - 2) >> 1 if s > 3 else 0
            code = s + 1 if s < 4 else ((2 + (s & 1)) << more) + (buffer & ((1 << more) - 1)) + 1
            buffer >>= more
            held -= more
            if code > 120:
                back = code - 120
            else:
                dx, dy = NEAR[code - 1]
                back = max(1, dx + dy * width)
            if back > at or at + length > n:
                raise ValueError("a back-reference leaves the image")
            if length <= back:
                out += out[at - back : at - back + length]
            else:
                again = out[at - back :]
                out += (again * (length // back + 1))[:length]
            at += length
        else:
            # the cache holds all pixels so far; they are put in when it is asked
            for v in out[cached:]:
                cache[(CACHE_HASH * v & 0xFFFFFFFF) >> shift] = v
            cached = at
            out.append(cache[s - 280])
            at += 1
    bits.at = 8 * place - held
    if bits.at > 8 * len(data):
        raise ValueError("the image ends too early")
    return out


def _half(a, b):
    return (a.astype(np.int16) + b) >> 1


def _predicted(mode: int, left, top, right, corner):
    """Prediction by mode from the neighbours left, top, top right and top left."""
    if mode == 0 or mode > 13:
        return np.array([0, 0, 0, 255])
    if mode < 5:
        return (left, top, right, corner)[mode - 1]
    if mode == 5:
        return _half(_half(left, right), top)
    if mode < 11:
        return _half(*((left, corner), (left, top), (corner, top), (top, right))[mode - 6]) if mode < 10 else _half(_half(left, corner), _half(top, right))
    l, t, c = (x.astype(int) for x in (left, top, corner))
    if mode == 11:
        guess = l + t - c
        return left if np.abs(guess - l).sum() < np.abs(guess - t).sum() else top
    if mode == 12:
        return np.clip(l + t - c, 0, 255)
    mean = (l + t) >> 1
    return np.clip(mean + np.trunc((mean - c) / 2).astype(int), 0, 255)


def _unpredict(out: np.ndarray, modes: np.ndarray, step: int) -> np.ndarray:
    height, width, _ = out.shape
    out[0, 0, 3] = (int(out[0, 0, 3]) + 255) & 255
    out[0] = np.cumsum(out[0], axis=0, dtype=np.uint8)
    out[:, 0] = np.cumsum(out[:, 0], axis=0, dtype=np.uint8)
    if (modes == 1).all():
        out[1:] = np.cumsum(out[1:], axis=1, dtype=np.uint8)
        return out
    for y in range(1, height):
        for x in range(1, width):
            right = out[y - 1, x + 1] if x + 1 < width else out[y, 0]
            guess = _predicted(int(modes[y >> step, x >> step]), out[y, x - 1], out[y - 1, x], right, out[y - 1, x - 1])
            out[y, x] += np.asarray(guess).astype(np.uint8)
    return out


def _uncross(out: np.ndarray, by: np.ndarray, step: int) -> np.ndarray:
    height, width, _ = out.shape
    at = by[np.arange(height)[:, None] >> step, np.arange(width) >> step].astype(np.int8).astype(int)
    signed = lambda x: x.astype(np.int8).astype(int)
    to_red, to_blue, red_to_blue = at[:, :, 2], at[:, :, 1], at[:, :, 0]
    green = signed(out[:, :, 1])
    red = (out[:, :, 0] + (to_red * green >> 5)).astype(np.uint8)
    blue = out[:, :, 2] + (to_blue * green >> 5) + (red_to_blue * signed(red) >> 5)
    out[:, :, 0], out[:, :, 2] = red, blue.astype(np.uint8)
    return out


def decode_image(data: bytes) -> np.ndarray:
    """One VP8L stream -> height x width x (red, green, blue, alpha)."""
    bits = Bits(data)
    if bits.read(8) != 0x2F:
        raise ValueError("not a lossless image")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version")
    undo, seen, packed = [], set(), width
    while bits.read(1):
        kind = bits.read(2)
        if kind in seen:
            raise ValueError("a transform occurs twice")
        seen.add(kind)
        if kind in (PREDICTOR, CROSS_COLOUR):
            step = bits.read(3) + 2
            by = _read_pixels(bits, -(-packed >> step), -(-height >> step), False)
            undo.append((kind, by[:, :, 1] if kind == PREDICTOR else by, step))
        elif kind == SUBTRACT_GREEN:
            undo.append((kind, None, 0))
        else:
            size = bits.read(8) + 1
            colours = np.cumsum(_read_pixels(bits, size, 1, False)[0], axis=0, dtype=np.uint8)
            share = 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0
            undo.append((kind, colours, share))
            packed = -(-packed >> share)
    out = _read_pixels(bits, packed, height, True)
    for kind, by, step in reversed(undo):
        if kind == PREDICTOR:
            out = _unpredict(out, by, step)
        elif kind == CROSS_COLOUR:
            out = _uncross(out, by, step)
        elif kind == SUBTRACT_GREEN:
            out[:, :, 0] += out[:, :, 1]
            out[:, :, 2] += out[:, :, 1]
        else:
            depth, per = 8 >> step, 1 << step
            x = np.arange(width)
            index = (out[:, x >> step, 1] >> ((x & (per - 1)) * depth).astype(np.uint8)) & ((1 << depth) - 1)
            table_ = np.zeros((256, 4), np.uint8)
            table_[: len(by)] = by
            out = table_[index]
    return out


def decode(media: bytes) -> list[np.ndarray]:
    """All images of a stored form, one RIFF file after the other."""
    out, at = [], 0
    while at < len(media):
        if len(media) < at + 20:
            raise ValueError("not a lossless WebP file")
        riff, size, form, chunk, n = struct.unpack_from("<4sI4s4sI", media, at)
        if (riff, form, chunk) != (b"RIFF", b"WEBP", b"VP8L") or at + 8 + size > len(media):
            raise ValueError("not a lossless WebP file")
        out.append(decode_image(media[at + 20 : at + 20 + n]))
        at += 8 + size
    return out


# -- writing -----------------------------------------------------------------------------------------------------------------


class Writer:
    """Numbers of given bits, lowest first."""

    def __init__(self):
        self.value, self.size = 0, 0

    def put(self, *pairs: tuple[int, int]) -> None:
        """Few numbers, one by one."""
        value, size = self.value, self.size
        for v, n in pairs:
            value |= v << size
            size += n
        self.value, self.size = value, size

    def many(self, values: np.ndarray, starts: np.ndarray, size: int) -> None:
        """Numbers of up to 33 bits at these places within the next size bits, none over another."""
        word, shifted = starts >> 5, values.view(np.uint64) << (starts & 31).view(np.uint64)
        words = (size >> 5) + 2
        # no two have a bit in common, so the sums of a word's parts stay below 2^32
        low = np.bincount(word, shifted & np.uint64(0xFFFFFFFF), words) + np.bincount(word + 1, shifted >> np.uint64(32), words)
        self.value |= int.from_bytes(low.astype("<u4").tobytes(), "little") << self.size
        self.size += size

    def bytes(self) -> bytes:
        return self.value.to_bytes((self.size + 7) // 8, "little")


def code_lengths(counts: np.ndarray, most: int) -> np.ndarray:
    """Lengths of a best prefix code for these counts, at most ``most`` bits; a symbol alone has 1."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    out[used] = _depths(counts[used].tolist(), most)
    return out


def _depths(weights: list[int], most: int) -> list[int]:
    """The same for counts above 0."""
    n = len(weights)
    if n < 2:
        return [1] * n
    while True:
        # two queues: symbols by weight, and sums, which come out in order by themselves
        order = sorted(range(n), key=weights.__getitem__)
        leaves, sums = [*map(weights.__getitem__, order), math.inf], [math.inf] * n
        up, leaf, inner = [0] * (2 * n - 1), 0, 0
        for new in range(n - 1):
            a, b = leaves[leaf], sums[inner]
            if a <= b:
                up[leaf] = new
                leaf += 1
                total, a = a, leaves[leaf]
            else:
                up[n + inner] = new
                inner += 1
                total, b = b, sums[inner]
            if a <= b:
                up[leaf] = new
                leaf += 1
                total += a
            else:
                up[n + inner] = new
                inner += 1
                total += b
            sums[new] = total
        deep = [0] * (n - 1)  # of the sums
        for i in range(n - 3, -1, -1):
            deep[i] = deep[up[n + i]] + 1
        out = [0] * n
        for i, k in zip(order, up):
            out[i] = deep[k] + 1
        if max(out) <= most:
            return out
        weights = [w // 2 + 1 for w in weights]  # flatter, until it is short enough


def _codes(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol's code as the stream has it, first bit lowest, and its bits; none where only one symbol is used."""
    codes, used = np.zeros(len(lengths), np.int64), np.flatnonzero(lengths)
    if len(used) < 2:
        return codes, np.zeros(len(lengths), np.int64)
    n = lengths[used]
    order = n.argsort(kind="stable")
    n = n[order]
    width = int(n[-1])
    spans = 1 << (width - n)
    codes[used[order]] = _reversed(width)[spans.cumsum() - spans]  # a code's bits in the highest of width: turned around they are the lowest
    return codes, lengths


def _write_code(to: Writer, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Writes the description of a prefix code for these counts and gives its codes."""
    used = np.flatnonzero(counts)
    if len(used) <= 2 and (not len(used) or used[-1] < 256):
        first, *second = used.tolist() or [0]
        to.put((1, 1), (len(second), 1), (1, 1), (first, 8), *((s, 8) for s in second))
        lengths = np.zeros(len(counts), np.int64)
        lengths[used] = 1
        return _codes(lengths)
    lengths = code_lengths(counts, 15)
    if len(used) == 1:  # a symbol that the short form can't name: a code of two, one of which never comes
        lengths[0] = 1
    # lengths as runs: of zeros by 17 and 18, of the one before by 16
    edges = [0, *((lengths[1:] != lengths[:-1]).nonzero()[0] + 1).tolist(), len(lengths)]
    tokens: list[tuple[int, int, int]] = []
    before = 8
    for value, run in zip(lengths[edges[:-1]].tolist(), [b - a for a, b in pairwise(edges)], strict=True):
        if value and value != before:
            tokens.append((value, 0, 0))
            run, before = run - 1, value
        while run:
            if value and run >= 3:
                k = min(run, 6)
                tokens.append((16, k - 3, 2))
            elif not value and run >= 11:
                k = min(run, 138)
                tokens.append((18, k - 11, 7))
            elif not value and run >= 3:
                k = run
                tokens.append((17, k - 3, 3))
            else:
                k = 1
                tokens.append((value, 0, 0))
            run -= k
    times = [0] * 19
    for t in tokens:
        times[t[0]] += 1
    of_lengths, met = [0] * 19, [s for s in range(19) if times[s]]
    for s, n in zip(met, _depths([times[s] for s in met], 7), strict=True):
        of_lengths[s] = n
    last = max(i for i, s in enumerate(LENGTH_ORDER) if of_lengths[s] or i < 4)
    to.put((0, 1), (last - 3, 4), *((of_lengths[s], 3) for s in LENGTH_ORDER[: last + 1]), (0, 1))
    codes = {s: (code, n) for s, n, code in _small_code(of_lengths)}
    to.put(*[pair for s, more, n in tokens for pair in (codes[s], (more, n))])
    return _codes(lengths)


def _prefixes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths or distance codes (from 1) as their prefix symbols, further bits and how many."""
    x = numbers - 1
    top = np.frexp(np.maximum(x, 1))[1] - 1
    more = np.where(x > 3, top - 1, 0)
    symbol = np.where(x > 3, 2 * top + (x >> np.maximum(top - 1, 0) & 1), x)
    return symbol, x & ((1 << more) - 1), more


def copies_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where copies are taken, left to right: their places, lengths and how far back they begin.

    A place refers to the one before it, among those whose LEAST samples share a 16-bit hash, if these samples are the same; copies go on as long as the places after it refer likewise.
    """
    n = len(x) - LEAST + 1
    none = np.zeros(0, np.int64)
    if n < 2:
        return none, none, none
    grams = np.ndarray(n, "<u4", np.ascontiguousarray(x).tobytes(), 0, (1,)).copy()  # LEAST samples from each place on
    order = np.argsort((grams * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.uint16), kind="stable")
    sorted_ = grams.take(order)
    same = (sorted_[1:] == sorted_[:-1]).nonzero()[0]
    later = order[same + 1]
    back = np.zeros(n + 1, np.int64)
    back[later] = later - order[same]
    if n > FARTHEST:
        back[back > FARTHEST] = 0
    # a copy lasts until the distance changes
    ends = (back[1:] != back[:-1]).nonzero()[0] + 1
    if not len(ends):
        return none, none, none
    begins = np.concatenate(([0], ends[:-1]))
    far = back[begins]
    long = ((far > 0) & (ends - begins > SHORTEST - LEAST)).nonzero()[0]
    p, taken = 0, []
    for begin, end, d in zip(begins[long].tolist(), ends[long].tolist(), far[long].tolist(), strict=True):
        p = max(p, begin)
        while end - p > SHORTEST - LEAST:
            k = min(end - p + LEAST - 1, LONGEST)
            taken.append((p, k, d))
            p += k
    if not taken:
        return none, none, none
    return tuple(np.array(taken).T)


@lru_cache(maxsize=8)
def _near_codes(width: int) -> np.ndarray:
    """By distance, its shortest code: that of the near place there, if there is one."""
    codes = np.arange(8 * width + 16) + 120
    for code, (dx, dy) in reversed([*enumerate(NEAR, 1)]):
        if dx + dy * width > 0:
            codes[dx + dy * width] = code
    return codes


def _write_samples(to: Writer, x: np.ndarray, width: int) -> None:
    """The main image: green x, red and blue 0, alpha 255, with copies."""
    places, lengths, backs = copies_of(x)
    free = np.ones(len(x), bool)
    for begin, end in zip(places.tolist(), (places + lengths).tolist(), strict=True):
        free[begin:end] = False
    literal = free.nonzero()[0]
    symbol = x[literal].astype(np.int64)
    near = _near_codes(width)
    distances = np.where(backs < len(near), near[np.minimum(backs, len(near) - 1)], backs + 120)
    (length_symbol, back_symbol), (length_more, back_more), (length_bits, back_bits) = (v.reshape(2, -1) for v in _prefixes(np.concatenate((lengths, distances))))
    counts = np.bincount(symbol, minlength=280) + np.bincount(length_symbol + 256, minlength=280)
    to.put((0, 1), (0, 1))  # neither a cache nor groups
    codes, sizes = _write_code(to, counts)
    for only in (0, 0, 255):
        to.put((1, 1), (0, 1), (1, 1), (only, 8))
    back_codes, back_sizes = _write_code(to, np.bincount(back_symbol, minlength=40))
    # a literal is one number; a copy two, its length and its distance with their further bits
    sizes_of = sizes[length_symbol + 256]
    long, long_bits = codes[length_symbol + 256] | length_more << sizes_of, sizes_of + length_bits
    sizes_of = back_sizes[back_symbol]
    far, far_bits = back_codes[back_symbol] | back_more << sizes_of, sizes_of + back_bits
    bits = np.zeros(len(x), np.int64)
    bits[literal], bits[places] = sizes[symbol], long_bits + far_bits
    ends = bits.cumsum()
    starts = ends - bits
    at = starts[places]
    to.many(np.concatenate((codes[symbol], long, far)), np.concatenate((starts[literal], at, at + long_bits)), int(ends[-1]))


def _write_palette(to: Writer, colours: np.ndarray) -> None:
    """Each colour less the one before, by one prefix code; alpha is 255 once and then stays."""
    steps = np.diff(colours, prepend=0).astype(np.uint8)
    to.put((0, 1))
    codes, sizes = (x.tolist() for x in _write_code(to, np.bincount(steps, minlength=280)))
    for only in (0, 0):
        to.put((1, 1), (0, 1), (1, 1), (only, 8))
    many = len(colours) > 1
    to.put((1, 1), (int(many), 1), (1, 1), (0 if many else 255, 8), *([(255, 8)] if many else []))
    to.put((1, 1), (0, 1), (0, 1), (0, 1))
    for i, s in enumerate(steps.tolist()):
        to.put((codes[s], sizes[s]), (int(many and i == 0), int(many)))


def encode_rows(samples: np.ndarray) -> bytes:
    """height x width samples -> one RIFF file."""
    height, width = samples.shape
    to = Writer()
    to.put((0x2F, 8), (width - 1, 14), (height - 1, 14), (0, 1), (0, 3))
    colours = np.flatnonzero(np.bincount(samples.ravel(), minlength=256))
    share = 3 if len(colours) <= 2 else 2 if len(colours) <= 4 else 1 if len(colours) <= 16 else 0
    index = samples
    if share:
        to.put((1, 1), (PALETTE, 2), (len(colours) - 1, 8))
        _write_palette(to, colours)
        number = np.zeros(256, np.uint8)
        number[colours] = np.arange(len(colours))
        rows = np.pad(number[samples], ((0, 0), (0, -width % (1 << share)))).reshape(height, -1, 1 << share)
        index = (rows << (np.arange(1 << share, dtype=np.uint8) * (8 >> share))).sum(2).astype(np.uint8)
    to.put((0, 1))
    flat = np.ascontiguousarray(index).reshape(-1)
    _write_samples(to, flat, index.shape[1])
    data = to.bytes()
    pad = len(data) & 1
    return struct.pack("<4sI4s4sI", b"RIFF", 12 + len(data) + pad, b"WEBP", b"VP8L", len(data)) + data + b"\0" * pad


def store(payload: bytes) -> bytes:
    """payload (a multiple of BLOCK bytes) as images of up to MOST_ROWS rows."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, BLOCK)
    return b"".join(encode_rows(rows[i : i + MOST_ROWS]) for i in range(0, len(rows), MOST_ROWS))


def load(media: bytes) -> bytes:
    return b"".join(np.ascontiguousarray(x[:, :, 1]).tobytes() for x in decode(media))


def padded(text: str) -> tuple[bytes, int]:
    raw = text.encode()
    return raw + b"\xff" * (max(-(-len(raw) // BLOCK), 1) * BLOCK - len(raw)), len(raw)


def describe(payload: bytes) -> str:
    """Means of the three channels, and which of 64 equal stretches are above the mean, as hex."""
    x = np.frombuffer(payload, np.uint8)
    means = [x[k::3].sum() / (len(x) // 3) for k in range(3)]
    per = len(x) // 64
    cells = x.reshape(64, per).sum(1) / per  # BLOCK is a multiple of 64
    return "rgb=" + ",".join(f"{m:.3f}" for m in means) + ";ahash=" + np.packbits(cells > cells.mean()).tobytes().hex()


def media_columns(docs: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """Each whole text stored as lossless WebP, read back, and described; with ``whole`` the stored bytes too, as column media."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, t in zip(batch["key"], batch["text"].fillna(""), strict=True):
                payload, n = padded(t)
                media = store(payload)
                back = load(media)
                rows.append((k, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), describe(back), *([media] if whole else [])))
            yield pd.DataFrame(rows, columns=[*names])

    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {source.schema['key'].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string" + (", media binary" if whole else "")
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    return source.mapInPandas(run, schema).withColumnRenamed("key", key)


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents"))
