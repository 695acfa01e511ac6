"""A writer of lossless WebP streams with every feature, for tests; written apart from the reader."""

import math
import struct

ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)


class Writer:
    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [value >> i & 1 for i in range(n)]

    def code(self, symbol, codes):
        n, value = codes[symbol]
        self.bits += [value >> i & 1 for i in range(n - 1, -1, -1)]

    def bytes(self):
        bits = self.bits + [0] * (-len(self.bits) % 8)
        return bytes(sum(b << i for i, b in enumerate(bits[k : k + 8])) for k in range(0, len(bits), 8))


def prefix_code(w, used, size):
    """Write a complete code over the used symbols; symbol -> (length, bits)."""
    used = sorted(set(used)) or [0]
    if len(used) == 1 and used[0] < 256:
        w.put(1, 1), w.put(0, 1), w.put(1, 1), w.put(used[0], 8)
        return {used[0]: (0, 0)}
    if len(used) == 1:
        used = [0, used[0]]
    n = max(1, math.ceil(math.log2(len(used))))
    short = 2**n - len(used)
    lengths = [0] * size
    for i, s in enumerate(used):
        lengths[s] = n - 1 if i < short and n > 1 else n
    w.put(0, 1), w.put(15, 4)
    for s in ORDER:
        w.put(4 if s < 16 else 0, 3)
    w.put(0, 1)
    four = {s: (4, s) for s in range(16)}
    for x in lengths:
        w.code(x, four)
    codes, value, last = {}, 0, 0
    for x, s in sorted((x, s) for s, x in enumerate(lengths) if x):
        value <<= x - last
        codes[s] = (x, value)
        value, last = value + 1, x
    return codes


def split(value):
    """A length or distance as prefix symbol, number of further bits, their value."""
    if value <= 4:
        return value - 1, 0, 0
    v = value - 1
    top = v.bit_length() - 1
    second = v >> (top - 1) & 1
    return 2 * top + second, top - 1, v & ((1 << (top - 1)) - 1)


def tokens_of(pixels, cache_bits, copies):
    """Literals, copies (at given starts: length, distance code, pixels back) and hits of the cache."""
    out, cache, i = [], {}, 0

    def key(p):
        a, r, g, b = p
        v = a << 24 | r << 16 | g << 8 | b
        return (0x1E35A7BD * v & 0xFFFFFFFF) >> (32 - cache_bits), v

    def remember(p):
        if cache_bits:
            k, v = key(p)
            cache[k] = v

    while i < len(pixels):
        if i in copies:
            length, code, back = copies[i]
            assert all(pixels[j] == pixels[j - back] for j in range(i, i + length))
            out.append(("copy", length, code))
            for j in range(i, i + length):
                remember(pixels[j])
            i += length
            continue
        if cache_bits and cache.get(key(pixels[i])[0]) == key(pixels[i])[1]:
            out.append(("cache", key(pixels[i])[0], None))
        else:
            out.append(("pixel", pixels[i], None))
        remember(pixels[i])
        i += 1
    return out


def image(w, pixels, main=False, cache_bits=0, copies=None, width=None, groups=None, step=2):
    """pixels: (a, r, g, b) in order. groups: block number -> group, where several groups of codes are to be used."""
    w.put(1, 1), w.put(cache_bits, 4) if cache_bits else None
    if not cache_bits:
        w.bits.pop()
        w.put(0, 1)
    tokens = tokens_of(pixels, cache_bits, copies or {})
    n_groups = 1
    if main:
        w.put(1 if groups else 0, 1)
        if groups:
            w.put(step - 2, 3)
            n_groups = max(groups) + 1
            image(w, [(255, 0, g, 0) for g in groups])
    where, at = [], 0
    for t in tokens:
        if groups:
            x, y = at % width, at // width
            where.append(groups[(y >> step) * -(-width >> step) + (x >> step)])
        else:
            where.append(0)
        at += t[1] if t[0] == "copy" else 1
    all_codes = []
    for g in range(n_groups):
        mine = [t for t, k in zip(tokens, where) if k == g]
        lit = [t[1] for t in mine if t[0] == "pixel"]
        cop = [t for t in mine if t[0] == "copy"]
        green = [p[2] for p in lit] + [256 + split(t[1])[0] for t in cop] + [280 + t[1] for t in mine if t[0] == "cache"]
        size = 280 + ((1 << cache_bits) if cache_bits else 0)
        all_codes.append([prefix_code(w, u, n) for u, n in ((green, size), ([p[1] for p in lit], 256), ([p[3] for p in lit], 256), ([p[0] for p in lit], 256), ([split(t[2])[0] for t in cop], 40))])
    for t, k in zip(tokens, where):
        green, red, blue, alpha, far = all_codes[k]
        if t[0] == "pixel":
            a, r, g, b = t[1]
            w.code(g, green), w.code(r, red), w.code(b, blue), w.code(a, alpha)
        elif t[0] == "cache":
            w.code(280 + t[1], green)
        else:
            s, n, v = split(t[1])
            w.code(256 + s, green), w.put(v, n)
            s, n, v = split(t[2])
            w.code(s, far), w.put(v, n)


def head(width, height):
    w = Writer()
    w.put(0x2F, 8), w.put(width - 1, 14), w.put(height - 1, 14), w.put(1, 1), w.put(0, 3)
    return w


def riff(data):
    pad = len(data) & 1
    return b"RIFF" + struct.pack("<I", 12 + len(data) + pad) + b"WEBPVP8L" + struct.pack("<I", len(data)) + data + b"\0" * pad


def guess(mode, l, t, tr, tl):
    """One channel's prediction for the modes that treat channels alone."""
    avg = lambda a, b: (a + b) // 2
    clamp = lambda v: max(0, min(255, v))
    return {
        1: l, 2: t, 3: tr, 4: tl, 5: avg(avg(l, tr), t), 6: avg(l, tl), 7: avg(l, t), 8: avg(tl, t), 9: avg(t, tr), 10: avg(avg(l, tl), avg(t, tr)),
        12: clamp(l + t - tl), 13: clamp(avg(l, t) + int((avg(l, t) - tl) / 2)),
    }[mode]


def predict(mode, l, t, tr, tl):
    if mode == 0:
        return (255, 0, 0, 0)
    if mode == 11:
        d_l = sum(abs((a + b - c) - a) for a, b, c in zip(l, t, tl))
        d_t = sum(abs((a + b - c) - b) for a, b, c in zip(l, t, tl))
        return l if d_l < d_t else t
    return tuple(guess(mode, *x) for x in zip(l, t, tr, tl))


def residuals(pixels, width, modes, step):
    out = []
    for i, p in enumerate(pixels):
        x, y = i % width, i // width
        if not i:
            q = (255, 0, 0, 0)
        elif not y:
            q = pixels[i - 1]
        elif not x:
            q = pixels[i - width]
        else:
            q = predict(modes[(y >> step) * -(-width >> step) + (x >> step)], pixels[i - 1], pixels[i - width], pixels[i - width + 1], pixels[i - width - 1])
        out.append(tuple((a - b) & 255 for a, b in zip(p, q)))
    return out
