"""A run of token ids as bytes, by a static range asymmetric numeral system.

One frequency table, of the run's own counts, serves all blocks of the run.
Blocks of BLOCK ids are independent; each interleaves LANES states (id t of a
block belongs to lane t mod LANES), 64-bit states with 32-bit words. Every STEP
steps the states and the place in the words are kept as a checkpoint, so a block
decodes from each of them at once. Each block has a crc32 of its ids and one of
its words.

Layout (little endian): magic; header; table (zlib: symbols as differences,
frequencies); document lengths (zlib); per block its sizes and checksums, the
checkpoints' places and states, the words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"LSRANS1\0"
LANES, STEP, BLOCK = 256, 256, 1 << 18
_HEAD = struct.Struct("<IIIIIIQI")  # bits, lanes, step, block, symbols, documents, ids, blocks
_BLOCK = struct.Struct("<IIII")  # ids, words, crc of ids, crc of words
_LOW = np.uint64(1 << 31)
_W = np.uint64(32)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols, their frequencies (each 1 or more, together 2^bits) and bits."""
    if ids.max(initial=0) < 1 << 22:
        every = np.bincount(ids)
        symbols = np.flatnonzero(every)
        counts = every[symbols]
    else:
        symbols, counts = np.unique(ids, return_counts=True)
    bits = max(16, int(len(symbols)).bit_length() + 2)
    total = 1 << bits
    f = np.maximum(1, counts * total // max(1, counts.sum())).astype(np.int64)
    order = np.argsort(-counts, kind="stable")
    gap = total - int(f.sum())
    if gap >= 0:
        f[order[0]] += gap
    for i in order:  # too many ones: taken back from the largest
        if gap >= 0:
            break
        take = min(int(f[i]) // 2, -gap)
        f[i] -= take
        gap += take
    return symbols.astype(np.uint32), f.astype(np.uint32), bits


def encode(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """Bytes of a run: ids of whole documents, one after the other, and their lengths."""
    ids = np.ascontiguousarray(ids, np.uint32)
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return MAGIC + _HEAD.pack(16, LANES, STEP, BLOCK, 0, len(lengths), 0, 0) + _zipped(np.zeros(0, np.uint32), np.zeros(0, np.uint32)) + _zipped(lengths.astype(np.uint32))
    symbols, freq, bits = frequencies(ids)
    cum = (np.cumsum(freq) - freq).astype(np.uint64)
    f64, shift, pb = freq.astype(np.uint64), np.uint64(63 - bits), np.uint64(bits)
    top = f64 << shift
    steps = -(-min(n, BLOCK) // LANES)
    code = np.zeros(blocks * BLOCK, np.int32)
    if symbols[-1] < 1 << 22:
        place = np.zeros(int(symbols[-1]) + 1, np.int32)
        place[symbols] = np.arange(len(symbols))
        code[:n] = place[ids]
    else:
        code[:n] = np.searchsorted(symbols, ids)
    # [step, block * lane]; the last block's missing ids come last and are skipped
    code = code.reshape(blocks, BLOCK // LANES, LANES).transpose(1, 0, 2)[:steps].reshape(steps, blocks * LANES)
    tail = n - (blocks - 1) * BLOCK  # ids of the last block
    lane = np.arange(blocks * LANES)
    x = np.full(blocks * LANES, _LOW, np.uint64)
    owner = (lane // LANES).astype(np.int32)
    words: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    spilt = np.zeros((steps, blocks), np.int64)
    states: dict[int, np.ndarray] = {}
    for s in range(steps - 1, -1, -1):
        live = (blocks - 1) * LANES + max(0, min(LANES, tail - s * LANES))  # lanes below this have an id in step s
        sym = code[s, :live]
        y = x[:live]
        f = f64[sym]
        full = y >= top[sym]
        if full.any():
            words.append((y[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            owners.append(owner[:live][full])
            spilt[s] = np.bincount(owners[-1], minlength=blocks)
            y = np.where(full, y >> _W, y)
        q = y // f
        x[:live] = (q << pb) + (y - q * f) + cum[sym]
        if s % STEP == 0:
            states[s] = x.copy()
    words, owners = words[::-1], owners[::-1]
    flat = np.concatenate([np.zeros(0, np.uint32), *words])
    who = np.concatenate([np.zeros(0, np.int32), *owners])
    flat = flat[np.argsort(who, kind="stable")]
    ends = np.cumsum(np.bincount(who, minlength=blocks))
    place = np.cumsum(spilt, 0) - spilt  # words of the block before each step
    out = [MAGIC, _HEAD.pack(bits, LANES, STEP, BLOCK, len(symbols), len(lengths), n, blocks), _zipped(np.diff(symbols, prepend=np.uint32(0)), freq), _zipped(lengths.astype(np.uint32))]
    for b in range(blocks):
        mine = ids[b * BLOCK : (b + 1) * BLOCK]
        w = flat[(ends[b - 1] if b else 0) : ends[b]].astype("<u4").tobytes()
        marks = [s for s in range(0, -(-len(mine) // LANES), STEP)]
        out.append(_BLOCK.pack(len(mine), len(w) // 4, zlib.crc32(mine.astype("<u4").tobytes()), zlib.crc32(w)))
        out.append(np.array([place[s, b] for s in marks], "<u4").tobytes())
        out += [states[s][b * LANES : (b + 1) * LANES].astype("<u8").tobytes() for s in marks]
        out.append(w)
    return b"".join(out)


def _zipped(*arrays: np.ndarray) -> bytes:
    z = zlib.compress(b"".join(a.astype("<u4").tobytes() for a in arrays), 6)
    return struct.pack("<I", len(z)) + z


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids and document lengths; ValueError where a checksum or a size is off."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a run of token ids")
    at = len(MAGIC)
    bits, lanes, step, block, kinds, docs, n, blocks = _HEAD.unpack_from(data, at)
    at += _HEAD.size

    def unzip(at: int) -> tuple[np.ndarray, int]:
        (size,) = struct.unpack_from("<I", data, at)
        return np.frombuffer(zlib.decompress(data[at + 4 : at + 4 + size]), "<u4"), at + 4 + size

    both, at = unzip(at)
    lengths, at = unzip(at)
    if len(both) != 2 * kinds or len(lengths) != docs or int(lengths.sum(dtype=np.int64)) != n:
        raise ValueError("table or document lengths don't fit the header")
    if not n:
        return np.zeros(0, np.uint32), lengths
    symbols, freq = np.cumsum(both[:kinds], dtype=np.uint32), both[kinds:]
    if int(freq.sum(dtype=np.int64)) != 1 << bits:
        raise ValueError("frequencies don't add up")
    cum = (np.cumsum(freq, dtype=np.uint64) - freq).astype(np.uint64)
    f64, slots = freq.astype(np.uint64), np.repeat(np.arange(kinds, dtype=np.int32), freq)
    crcs, sizes, states, pos, have, words, base = [], [], [], [], [], [], 0
    for _ in range(blocks):
        ids, count, crc_ids, crc_words = _BLOCK.unpack_from(data, at)
        at += _BLOCK.size
        marks = -(-(-(-ids // lanes)) // step)
        pos.append(np.frombuffer(data, "<u4", marks, at).astype(np.int64) + base)
        at += 4 * marks
        states.append(np.frombuffer(data, "<u8", marks * lanes, at).reshape(marks, lanes))
        at += 8 * marks * lanes
        w = data[at : at + 4 * count]
        if zlib.crc32(w) != crc_words or len(w) != 4 * count:
            raise ValueError("a block's words are damaged")
        words.append(np.frombuffer(w, "<u4"))
        at, base = at + 4 * count, base + count
        per = step * lanes
        have.append(np.minimum(per, ids - per * np.arange(marks)))
        crcs.append(crc_ids)
        sizes.append(ids)
    x = np.concatenate(states).astype(np.uint64)
    at_word, left = np.concatenate(pos), np.concatenate(have)
    stream = np.concatenate([*words, np.zeros(1, np.uint32)]).astype(np.uint64)
    mask, pb = np.uint64((1 << bits) - 1), np.uint64(bits)
    out = np.zeros((step, len(x), lanes), np.int32)
    columns = np.arange(lanes)
    even = bool((left == step * lanes).all())
    for s in range(-(-int(left.max()) // lanes)):
        slot = x & mask
        sym = slots[slot.astype(np.int64)]
        y = f64[sym] * (x >> pb) + slot - cum[sym]
        need = y < _LOW
        if not even:
            live = columns < (left - s * lanes)[:, None]
            need &= live
            y = np.where(live, y, x)
        rank = np.cumsum(need, 1)
        w = stream[np.where(need, at_word[:, None] + rank - 1, 0)]
        x = np.where(need, (y << _W) | w, y)
        at_word = at_word + rank[:, -1]
        out[s] = sym
    flat = out.transpose(1, 0, 2).reshape(len(x), step * lanes)
    ids = symbols[np.concatenate([flat[i, :k] for i, k in enumerate(left.tolist())])]
    at = 0
    for size, crc in zip(sizes, crcs, strict=True):
        if zlib.crc32(ids[at : at + size].astype("<u4").tobytes()) != crc:
            raise ValueError("a block's ids don't match their checksum")
        at += size
    return ids, lengths
