"""Windows of long token sequences, gathered by the least hash of the grams that they hold.

Windows of ``width`` tokens that hold the same least gram of ``gram`` tokens, one after another, are
one run.  Equal windows have equal least grams, wherever they stand, so comparing the runs of each
gram finds all equal windows; and a text that is repeated falls into the same runs each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Odd multipliers of two polynomial hashes modulo 2^64, and their inverses.
BASE, SECOND = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 1 << 64)
_INVERSES = {BASE: INVERSE, SECOND: pow(SECOND, -1, 1 << 64)}
#: Tokens that are hashed at once.
SEGMENT = 1 << 20
#: Windows of one run at most, so that a long monotone text doesn't make one long run.
LONGEST = 1 << 12

_powers = {base: np.ones(1, np.uint64) for pair in _INVERSES.items() for base in pair}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers[base]
    if len(have) < n:
        with np.errstate(over="ignore"):
            out = np.full(max(n, 2 * len(have)), base, np.uint64)
            out[0] = 1
            have = _powers[base] = np.multiply.accumulate(out)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits; in place on a fresh array."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


#: What stands for each byte in the hashes.
BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def prefixes(tokens: np.ndarray, base: int = BASE) -> np.ndarray:
    """p[i] = sum of tokens[j] * base^j for j < i, modulo 2^64."""
    out = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(tokens * powers(base, len(tokens)), out=out[1:])
    return out


def spans(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of tokens[start:end] for each pair, wherever it stands."""
    return mix((prefix[end] - prefix[start]) * powers(INVERSE, len(prefix))[start] + (end - start).astype(np.uint64))


def grams(prefix: np.ndarray, size: int, base: int = BASE) -> np.ndarray:
    """The hash of each run of ``size`` tokens."""
    n = len(prefix) - size
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((prefix[size:] - prefix[:-size]) * powers(_INVERSES[base], n) + np.uint64(size))


def both_grams(tokens: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each run of ``size`` tokens, of unlike token values and multipliers."""
    return grams(prefixes(tokens), size), grams(prefixes(mix(tokens ^ np.uint64(0xA5A5F00DD00DF5A5)), SECOND), size, SECOND)


def least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    have, out = 1, x
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """As flat, of texts in a list."""
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes end to end, and their offsets."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts that lie end to end: hash, first byte, end byte, and each text's first word.

    Words are runs of bytes other than the space and 0x09 to 0x0D; bounds are the texts' offsets.
    """
    hashes, firsts, lasts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = 0
    while at < len(data):
        # blocks end at white space or a text's end, so that no word is cut
        end = at + SEGMENT
        if end < len(data):
            gap = np.flatnonzero(~_INSIDE[data[end : end + SEGMENT]])
            end = min(end + int(gap[0]) if len(gap) else len(data), int(bounds[np.searchsorted(bounds, end)]))
        end = min(end, len(data))
        inside = _INSIDE[data[at:end]]
        edge = np.zeros(end - at + 1, bool)
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[bounds[np.searchsorted(bounds, at) : np.searchsorted(bounds, end, side="right")] - at] = True
        edge[[0, -1]] = True
        place = np.flatnonzero(edge)
        kept = inside[place[:-1]]
        starts, ends = place[:-1][kept], place[1:][kept]
        hashes.append(spans(prefixes(BYTES[data[at:end]]), starts, ends))
        firsts.append(starts + at)
        lasts.append(ends + at)
        at = end
    starts = np.concatenate(firsts)
    return np.concatenate(hashes), starts, np.concatenate(lasts), np.searchsorted(starts, bounds)


_INSIDE = np.ones(256, bool)
_INSIDE[[0x20, *range(0x09, 0x0E)]] = False


def segments(bounds: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """First text and offsets of stretches of at most SEGMENT tokens; longer texts are cut.

    Parts of a cut text overlap by width - 1 tokens, so each window lies in exactly one.
    """
    text, last = 0, len(bounds) - 1
    while text < last:
        if bounds[text + 1] - bounds[text] > SEGMENT:
            for at in range(int(bounds[text]), int(bounds[text + 1]) - width + 1, SEGMENT - width + 1):
                yield text, np.array([at, min(at + SEGMENT, bounds[text + 1])])
            text += 1
        else:
            end = int(np.searchsorted(bounds, bounds[text] + SEGMENT, side="right")) - 1
            yield text, bounds[text : end + 1]
            text = end


def runs(data: np.ndarray, bounds: np.ndarray, width: int, gram: int, table: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The runs of texts that lie end to end, as in runs_of; with table, data indexes token hashes."""
    found = []
    for text, own in segments(bounds, width):
        tokens = data[own[0] : own[-1]]
        one = runs_of(tokens if table is None else table[tokens], own - own[0], width, gram)
        found.append((*one[:2], one[2] + text, one[3] + (own[0] - bounds[text]), *one[4:]))
    empty = runs_of(np.zeros(0, np.uint64), np.zeros(1, np.int64), width, gram)
    return tuple(np.concatenate(x) for x in zip(*(found or [empty]), strict=True))


def runs_of(tokens: np.ndarray, bounds: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """anchor, content hash, text, start (in its text), count of windows, self of each run.

    tokens are hashes of texts' tokens end to end, bounds the texts' offsets in them.  A run's
    content is the tokens of all its windows: count + width - 1 of them.  self tells that the least
    gram stands in the run more than once, so that windows of the run may equal each other.
    """
    none = np.zeros(0, np.int64)
    n = len(tokens) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), none, none, none, np.zeros(0, bool)
    prefix = prefixes(tokens)
    gram_hash, reach = grams(prefix, gram), width - gram + 1
    anchor = least(gram_hash, reach)
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)[:n]
    whole = text == np.repeat(np.arange(len(sizes)), sizes)[width - 1 :]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, n))
    repeated = np.zeros(len(first), bool)
    # a gram is least in some window if the greatest of its windows' least grams is itself
    edge = np.zeros(reach - 1, np.uint64)
    chosen = np.flatnonzero(~least(~np.concatenate([edge, anchor, edge]), reach) == gram_hash)
    # a run goes on from one to the next up to reach apart; at reach itself no window holds both
    again = (gram_hash[chosen[1:]] == gram_hash[chosen[:-1]]) & (chosen[1:] - chosen[:-1] <= reach)
    repeated[(np.cumsum(new) - 1)[np.clip(chosen[1:][again] - reach + 1, 0, n - 1)]] = True
    repeated[(np.cumsum(new) - 1)[np.clip(chosen[:-1][again], 0, n - 1)]] = True
    keep = whole[first]
    first, count, repeated = first[keep], count[keep], repeated[keep]
    if len(count) and count.max() > LONGEST:
        parts = -(-count // LONGEST)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(first, parts) + step * LONGEST
        count = np.minimum(np.repeat(count, parts) - step * LONGEST, LONGEST)
        repeated = np.repeat(repeated, parts)
    return anchor[first], spans(prefix, first, first + count + width - 1), text[first], first - bounds[text[first]], count, repeated
