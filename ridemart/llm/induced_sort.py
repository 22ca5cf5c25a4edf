"""External induced suffix sorting with common-prefix values, to a bounded depth.

A suffix is type L if it is larger than the one after it, else S; S* is an S
suffix after an L one.  The S* suffixes are sorted first (external distribution
by eight bytes at a time, recursing into ranges that stay too large).  They
induce the order of all L suffixes, and those the order of all S suffixes: a
suffix goes to the end of the queue of its first byte when the suffix after it
is met in order.  The queues, one per byte value, together are a monotone
priority queue of tuples (position, byte before, common prefix with the tuple
ahead); whatever exceeds the memory bound lies in one scratch file per queue.

The common prefix of two induced neighbours is one more than the smallest
common prefix met between their inducers; the smallest since each queue last
grew is kept per queue, so no tuple is looked at again.

Two suffixes that agree in the first ``depth`` bytes may come in either order,
and common prefixes are capped at ``depth``; that is all a search for repeats
of that length needs, and it bounds the recursion.
"""

from __future__ import annotations

import os
import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

_TUPLE = np.dtype([("position", "<u4"), ("before", "u1"), ("common", "u1")])
#: Bytes after the text that hold separators, so that reads of a few words never end outside.
PADDING = 72


class _Queues:
    """First-in first-out queues of tuples by byte value, within a memory bound."""

    def __init__(self, memory: int, block: int, folder: str):
        self.memory, self.block, self.folder = memory, block, folder
        self.parts = [deque() for _ in range(256)]
        self.sizes = np.zeros(256, np.int64)
        self.files: dict[int, list] = {}  # queue -> [file, read place, tuples left]
        self.spilled = 0

    def push(self, queue: int, tuples: np.ndarray) -> None:
        self.parts[queue].append(tuples)
        self.sizes[queue] += len(tuples)
        while int(self.sizes.sum()) * _TUPLE.itemsize > self.memory:
            self._spill(int(self.sizes.argmax()))

    def _spill(self, queue: int) -> None:
        if queue not in self.files:
            self.files[queue] = [open(os.path.join(self.folder, f"queue-{id(self)}-{queue}"), "w+b"), 0, 0]
        entry = self.files[queue]
        entry[0].seek(0, os.SEEK_END)
        for part in self.parts[queue]:
            entry[0].write(part.tobytes())
            entry[2] += len(part)
            self.spilled += len(part)
        self.parts[queue].clear()
        self.sizes[queue] = 0

    def pop(self, queue: int) -> np.ndarray | None:
        """The next block of the queue: first what is on disk, which is older."""
        entry = self.files.get(queue)
        if entry and entry[2]:
            n = min(self.block, entry[2])
            entry[0].seek(entry[1])
            tuples = np.frombuffer(entry[0].read(n * _TUPLE.itemsize), _TUPLE)
            entry[1] += n * _TUPLE.itemsize
            entry[2] -= n
            return tuples
        parts, taken = [], 0
        while self.parts[queue] and taken < self.block:
            parts.append(self.parts[queue].popleft())
            taken += len(parts[-1])
        self.sizes[queue] -= taken
        return np.concatenate(parts) if parts else None

    def close(self) -> None:
        for entry in self.files.values():
            entry[0].close()


class _Stack:
    """Blocks written in order and read back from the last one, each reversed (L suffixes between the two passes)."""

    def __init__(self, memory: int, folder: str):
        self.memory, self.folder, self.blocks, self.size = memory, folder, [], 0
        self.file = None

    def push(self, tuples: np.ndarray) -> None:
        if self.size + tuples.nbytes > self.memory:
            if self.file is None:
                self.file = open(os.path.join(self.folder, f"stack-{id(self)}"), "w+b")
            self.file.seek(0, os.SEEK_END)
            self.blocks.append((self.file.tell(), len(tuples)))
            self.file.write(tuples.tobytes())
        else:
            self.size += tuples.nbytes
            self.blocks.append(tuples)

    def pop(self) -> np.ndarray:
        block = self.blocks.pop()
        if isinstance(block, tuple):
            self.file.seek(block[0])
            return np.frombuffer(self.file.read(block[1] * _TUPLE.itemsize), _TUPLE)
        self.size -= block.nbytes
        return block

    def close(self) -> None:
        if self.file:
            self.file.close()


class _Minima:
    """Smallest common prefix since each queue last grew."""

    def __init__(self, depth: int):
        self.since = np.full(256, depth, np.uint8)
        self.started = np.zeros(256, bool)
        self.depth = depth

    def induce(self, common: np.ndarray, targets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For a block of common prefixes, the tuples ``at`` which go to queues ``targets``:
        (order by queue, common prefix of each with the tuple ahead of it there)."""
        n = len(common)
        table = [common]
        while 1 << len(table) <= n:
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))

        def smallest(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            """Minimum over low..high inclusive, ``depth`` for an empty range."""
            out = np.full(len(low), self.depth, np.uint8)
            size = high - low + 1
            power = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
            for k in np.unique(power[size > 0]).tolist() if len(size) else []:
                mine = np.flatnonzero((power == k) & (size > 0))
                out[mine] = np.minimum(table[k][low[mine]], table[k][high[mine] - (1 << k) + 1])
            return out

        order = np.argsort(targets, kind="stable")
        queue, place = targets[order], at[order]
        head = np.ones(len(order), bool)
        head[1:] = queue[1:] != queue[:-1]
        low = np.empty(len(order), np.int64)
        low[1:] = place[:-1] + 1
        low[head] = 0
        least = smallest(low, place)
        first = np.flatnonzero(head)
        least[first] = np.minimum(least[first], self.since[queue[first]])
        least = np.minimum(least + 1, self.depth).astype(np.uint8)
        fresh = first[~self.started[queue[first]]]
        least[fresh] = 0
        # Queues that grew start anew behind their last tuple; the others go on over the whole block.
        last = np.append(first[1:], len(order))[:len(first)] - 1
        self.since = np.minimum(self.since, common.min() if n else self.depth).astype(np.uint8)
        if len(first):
            self.since[queue[first]] = smallest(place[last] + 1, np.full(len(last), n - 1))
            self.started[queue[first]] = True
        return order, least


def _words(text: np.ndarray) -> np.ndarray:
    """Eight bytes from any position, as big-endian numbers (a view)."""
    return np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))


def _common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of suffixes, capped at ``depth``."""
    words, out, todo = _words(text), np.zeros(len(a), np.int64), np.arange(len(a))
    for step in range(0, depth, 8):
        if not len(todo):
            break
        differ = words[a[todo].astype(np.int64) + step].astype(np.uint64) ^ words[b[todo].astype(np.int64) + step].astype(np.uint64)
        same = differ == 0
        zeros = np.zeros(len(differ), np.int64)
        zeros[~same] = 63 - (np.frexp(np.maximum(differ[~same] >> np.uint64(11), 1).astype(np.float64))[1] - 1 + 11)
        low = ~same & (differ >> np.uint64(11) == 0)
        zeros[low] = 64 - np.frexp(differ[low].astype(np.float64))[1]
        out[todo] += np.where(same, 8, zeros // 8)
        todo = todo[same]
    return np.minimum(out, depth).astype(np.uint8)


def _sort_in_memory(text: np.ndarray, positions: np.ndarray, depth: int, step: int) -> np.ndarray:
    words = _words(text)
    positions = positions[np.argsort(words[positions.astype(np.int64) + step].astype(np.uint64), kind="stable")]
    tied = None
    for at in range(step, depth, 8):
        key = words[positions.astype(np.int64) + at].astype(np.uint64)
        if tied is None:
            new = np.ones(len(positions), bool)
            new[1:] = key[1:] != key[:-1]
        else:
            mine = np.flatnonzero(tied)
            group = np.cumsum(new)[mine]
            order = np.lexsort((key[mine], group))
            positions[mine] = positions[mine[order]]
            key = key[mine[order]]
            split = np.ones(len(mine), bool)
            split[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
            new[mine] |= split
        tied = ~new
        tied[:-1] |= ~new[1:]
        if not tied.any():
            break
    return positions


def _sorted_stars(text: np.ndarray, positions: np.ndarray, depth: int, memory: int, folder: str, step: int = 0) -> Iterator[np.ndarray]:
    """S* positions in suffix order (to ``depth``), in blocks that fit the memory bound."""
    room = max(16, memory // 32)
    if len(positions) <= room:
        if len(positions):
            yield _sort_in_memory(text, np.array(positions), depth, step)
        return
    if step >= depth:
        for a in range(0, len(positions), room):
            yield np.array(positions[a:a + room])
        return
    words = _words(text)
    sample = np.sort(words[positions[::max(1, len(positions) // 4096)].astype(np.int64) + step].astype(np.uint64))
    parts = 2 * len(positions) // room + 1
    cuts = np.unique(sample[np.linspace(0, len(sample) - 1, parts + 1).astype(int)[1:-1]])
    # Ranges: below, equal to and above each cut, so that one frequent word is a range of its own.
    files = [open(os.path.join(folder, f"stars-{step}-{id(positions)}-{k}"), "w+b") for k in range(2 * len(cuts) + 1)]
    try:
        for a in range(0, len(positions), room):
            block = np.array(positions[a:a + room])
            key = words[block.astype(np.int64) + step].astype(np.uint64)
            part = np.searchsorted(cuts, key, "left") + np.searchsorted(cuts, key, "right")
            order = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[order], np.arange(len(files) + 1))
            for k, file in enumerate(files):
                file.write(block[order[bounds[k]:bounds[k + 1]]].tobytes())
        for k, file in enumerate(files):
            file.flush()
            if file.tell():
                mine = np.memmap(file.name, positions.dtype, "r")
                yield from _sorted_stars(text, mine, depth, memory, folder, step + 8 if k % 2 else step)
    finally:
        for file in files:
            file.close()
            os.unlink(file.name)


def star_positions(text: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """Positions of S* suffixes, ascending; the text's last byte (its smallest) is one.

    Right to left in blocks: bytes in a run have the type of the run's last,
    which the byte after it decides.
    """
    n = len(text)
    found = [np.array([n - 1], np.uint32)] if n > 1 and text[n - 2] > text[n - 1] else []
    smaller_at_end = True  # type of the byte right of the block
    for b in range(n - 1, 0, -block):
        a = max(0, b - block)
        part = text[a:b + 1]
        ends = np.flatnonzero(part[:-1] != part[1:])
        types = np.append(part[ends] < part[ends + 1], smaller_at_end)
        starts = np.concatenate([[0], ends + 1])  # of the runs; the first may begin further left
        if len(starts) and starts[-1] == b - a:  # the run that begins right of the block is not its own
            starts, types = starts[:-1], types[:-1]
        before = np.concatenate([[text[a - 1] if a else 0], part[starts[1:] - 1]])
        star = types & (before > part[starts])
        found.append((starts[star] + a).astype(np.uint32))
        smaller_at_end = bool(types[0])
    return np.concatenate(found[::-1]) if found else np.zeros(0, np.uint32)


def sorted_suffixes(text: np.ndarray, depth: int, memory: int = 64 << 20, block: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (positions, common prefix with the suffix yielded before), from the largest suffix to the smallest.

    ``text``: bytes below 255 that end in one separator 0 (none right before it); it is
    padded here.  Common prefixes are capped at ``depth``.
    """
    text = np.concatenate([text, np.zeros(PADDING, np.uint8)])
    n = len(text) - PADDING
    depth = min(depth, 254)
    with tempfile.TemporaryDirectory(prefix="induced-") as folder:
        queues = _Queues(memory // 2, block, folder)
        larger = _Stack(memory // 4, folder)
        try:
            yield from _passes(text, n, depth, memory, block, folder, queues, larger)
        finally:
            queues.close()
            larger.close()


def _passes(text, n, depth, memory, block, folder, queues: _Queues, larger: _Stack):
    stars = star_positions(text[:n])
    if stars.nbytes > memory // 4:
        path = os.path.join(folder, "stars")
        stars.tofile(path)
        stars = np.memmap(path, "<u4", "r")
    minima = _Minima(depth)

    def grow(positions, before, common, wanted) -> None:
        """Send the suffixes one to the left of the wanted ones to their queues."""
        at = np.flatnonzero(wanted)
        order, least = minima.induce(common, before[at], at)
        if not len(order):
            return
        tuples = np.empty(len(order), _TUPLE)
        left = positions[at[order]] - 1
        tuples["position"], tuples["common"] = left, least
        tuples["before"] = text[np.maximum(left, 1) - 1]
        tuples["before"][left == 0] = 255
        queue = before[at[order]]
        cuts = np.flatnonzero(np.diff(queue)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(queue)]):
            queues.push(int(queue[a]), tuples[a:b])

    # Left to right: L suffixes of each byte, then its S* suffixes.
    star_blocks, waiting, last = _sorted_stars(text, stars, depth, memory // 4, folder), None, None
    counts = []

    def stars_of(byte: int):
        nonlocal waiting
        while True:
            if waiting is None or not len(waiting):
                waiting = next(star_blocks, None)
                if waiting is None:
                    return
            stop = int(np.searchsorted(text[waiting.astype(np.int64)], byte, "right"))
            if not stop:
                return
            part, waiting = waiting[:stop], waiting[stop:]
            for a in range(0, len(part), block):
                yield part[a:a + block]

    for byte in range(256):
        blocks = 0
        while (tuples := queues.pop(byte)) is not None:
            position = tuples["position"].astype(np.int64)
            larger.push(tuples)
            blocks += 1
            before = tuples["before"]
            grow(position, before, tuples["common"], (position > 0) & (before >= byte) & (before != 255))
            last = position[-1]
        counts.append(blocks)
        for part in stars_of(byte):
            position = part.astype(np.int64)
            ahead = np.concatenate([[position[0] if last is None else last], position[:-1]])
            common = _common_prefix(text, ahead, position, depth)
            if last is None:
                common[0] = 0
            before = np.where(position > 0, text[np.maximum(position, 1) - 1], 255).astype(np.uint8)
            grow(position, before, common, position > 0)
            last = position[-1]

    # Right to left: S suffixes of each byte, then its L suffixes.
    minima, last = _Minima(depth), None
    for byte in range(255, -1, -1):
        while (tuples := queues.pop(byte)) is not None:
            position = tuples["position"].astype(np.int64)
            before, common = tuples["before"], tuples["common"]
            yield position, common
            grow(position, before, common, (position > 0) & (before <= byte))
            last = position[-1]
        following = None
        for _ in range(counts[byte]):
            tuples = larger.pop()[::-1]
            position = tuples["position"].astype(np.int64)
            # Upwards a tuple knows the one below it; downwards it needs the one above.
            common = np.empty(len(tuples), np.uint8)
            common[1:] = tuples["common"][:-1]
            if following is not None:
                common[0] = following
            else:
                common[0] = 0 if last is None else _common_prefix(text, np.array([last]), position[:1], depth)[0]
            following = tuples["common"][-1]
            before = tuples["before"]
            yield position, common
            grow(position, before, common, (position > 0) & (before < byte))
            last = position[-1]
    # The final separator has no suffix after it that could induce it; it is the smallest.
    end = np.array([n - 1], np.int64)
    yield end, (np.zeros(1, np.uint8) if last is None else _common_prefix(text, np.array([last]), end, depth))
