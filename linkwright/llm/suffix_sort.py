"""Deep-shallow suffix sorting: multikey quicksort to a shallow depth, blind tries for groups with longer common prefixes."""

from __future__ import annotations

import numpy as np

#: Bytes that multikey quicksort looks at, eight at a time; what still ties goes to a blind trie.
SHALLOW = 48


class BlindTrie:
    """Sorts strings that share long prefixes: a descent looks at branching bytes only, then one comparison with the leaf
    it came to gives the common prefix, where the new string branches off. Strings are numbers of ``width`` bytes."""

    def __init__(self, width: int):
        self.width, self.root = width, None

    def _byte(self, x: int, at: int) -> int:
        return (x >> 8 * (self.width - 1 - at)) & 255

    def add(self, x: int, item: int) -> None:
        if self.root is None:
            self.root = (x, [item])
            return
        node, path = self.root, []
        while isinstance(node, list):  # [depth, children]
            path.append(node)
            kids = node[1]
            node = kids.get(self._byte(x, node[0])) or next(iter(kids.values()))
        if not (differ := x ^ node[0]):
            node[1].append(item)
            return
        depth = self.width - (differ.bit_length() + 7) // 8
        parent, below = None, self.root
        for step in path:
            if step[0] >= depth:
                break
            parent, below = step, step[1].get(self._byte(x, step[0]))
        leaf = (x, [item])
        if isinstance(below, list) and below[0] == depth:
            below[1][self._byte(x, depth)] = leaf
            return
        if below is None:
            parent[1][self._byte(x, parent[0])] = leaf
            return
        inside = below
        while isinstance(inside, list):
            inside = next(iter(inside[1].values()))
        new = [depth, {self._byte(x, depth): leaf, self._byte(inside[0], depth): below}]
        if parent is None:
            self.root = new
        else:
            parent[1][self._byte(x, parent[0])] = new

    def items(self):
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                yield node[1]


def deep_shallow(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the strings' order by bytes, of which at most ``width`` count, and the common prefix of each
    with the one before it. Ends sort like zero bytes, of equal ones the shorter first."""
    n = len(strings)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    width8 = -(-width // 8) * 8
    size = np.array([min(len(s), width) for s in strings])
    padded = [s[:width].ljust(width8, b"\0") for s in strings]
    words = np.frombuffer(b"".join(padded), dtype=">u8").reshape(n, -1).astype(np.uint64)
    shallow = min(SHALLOW // 8, words.shape[1])
    numbers = [int.from_bytes(p, "big") for p in padded]
    out: list[int] = []
    stack = [(np.arange(n), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            out.append(int(group[0]))
        elif depth == shallow:
            trie = BlindTrie(width8)
            for i in group.tolist():
                trie.add(numbers[i], i)
            for same in trie.items():
                out += sorted(same, key=lambda i: size[i])
        else:
            v = words[group, depth]
            pivot = np.sort(v[[0, len(v) // 2, -1]])[1]
            less, more = v < pivot, v > pivot
            for part, d in ((group[more], depth), (group[~(less | more)], depth + 1), (group[less], depth)):
                if len(part):
                    stack.append((part, d))
    order = np.array(out)
    common = np.zeros(n, dtype=np.int64)
    for k in range(1, n):
        differ = numbers[out[k - 1]] ^ numbers[out[k]]
        common[k] = width8 - (differ.bit_length() + 7) // 8
    common[1:] = np.minimum(common[1:], np.minimum(size[order[1:]], size[order[:-1]]))
    return order, common
