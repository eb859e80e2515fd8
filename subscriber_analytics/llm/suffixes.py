"""Deep-shallow suffix sorting of a small set of byte strings."""

from __future__ import annotations

# Bytes that multikey quicksort looks at before a group of equal beginnings goes into a blind trie.
SHALLOW = 32
# Bytes of a symbol: strings are split by so many bytes at once.
SYMBOL = 8


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the longest common beginning; the first ``start`` bytes are known to be equal."""
    low, high = start, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class BlindTrie:
    """Strings in order, by branching bytes alone; a string is compared once, with one leaf."""

    def __init__(self, strings: list[bytes], first: int) -> None:
        self.strings = strings
        self.root: list | int = first

    @staticmethod
    def _byte(string: bytes, at: int) -> int:
        # The end of a string comes before any byte.
        return string[at] if at < len(string) else -1

    def insert(self, index: int, start: int) -> None:
        """A node is [depth, {byte: child}], a leaf the index of a string."""
        string = self.strings[index]
        node = self.root
        while isinstance(node, list):
            node = node[1].get(self._byte(string, node[0])) if self._byte(string, node[0]) in node[1] else next(iter(node[1].values()))
        other = self.strings[node]
        depth = common_prefix(string, other, start)
        mine, its = self._byte(string, depth), self._byte(other, depth)
        above, node = None, self.root
        while isinstance(node, list) and node[0] < depth:
            above = (node, self._byte(string, node[0]))
            node = node[1][above[1]]
        if isinstance(node, list) and node[0] == depth:
            if mine in node[1]:
                # Equal strings end at one leaf; a second one hangs below a byte of its own.
                mine = -2 - index
            node[1][mine] = index
            return
        if mine == its:
            mine = -2 - index
        made = [depth, {its: node, mine: index}]
        if above is None:
            self.root = made
        else:
            above[0][1][above[1]] = made

    def sorted(self, depth: int) -> tuple[list[int], list[int]]:
        """Leaves in order, and of each the common length with the one before (``depth`` for the first)."""
        order: list[int] = []
        common: list[int] = []
        stack: list[tuple[list | int, int]] = [(self.root, depth)]
        while stack:
            node, shared = stack.pop()
            if not isinstance(node, list):
                order.append(node)
                common.append(shared)
                continue
            for n, key in reversed(list(enumerate(sorted(node[1])))):
                stack.append((node[1][key], node[0] if n else shared))
        return order, common


def deep_shallow(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Order of the strings, and of each the common length with the one before it in order.

    ``depth`` bytes are known to be equal in all. Multikey quicksort splits by a pivot symbol at a
    time; a group that is still together at ``shallow`` bytes is long alike, and goes into a blind trie.
    """
    order: list[int] = []
    common: list[int] = []
    # Groups still to be sorted, the first one on top, and the bytes known to be equal in each; a group
    # whose strings end there holds equal ones. -1: to be compared with the one before.
    stack = [(list(range(len(strings))), depth, False)]
    while stack:
        group, at, ended = stack.pop()
        if not group:
            continue
        if len(group) == 1 or ended:
            order += group
            common += [-1] + [at] * (len(group) - 1)
        elif at >= shallow:
            trie = BlindTrie(strings, group[0])
            for index in group[1:]:
                trie.insert(index, at)
            found, lengths = trie.sorted(at)
            order += found
            common += [-1, *lengths[1:]]
        else:
            pivot = strings[group[len(group) // 2]][at:at + SYMBOL]
            less, same, more = [], [], []
            for index in group:
                symbol = strings[index][at:at + SYMBOL]
                (same if symbol == pivot else less if symbol < pivot else more).append(index)
            stack.append((more, at, False))
            stack.append((same, at + len(pivot), len(pivot) < SYMBOL))
            stack.append((less, at, False))
    for n in range(1, len(order)):
        if common[n] < 0:
            common[n] = common_prefix(strings[order[n - 1]], strings[order[n]], depth)
    if common:
        common[0] = depth
    return order, common
