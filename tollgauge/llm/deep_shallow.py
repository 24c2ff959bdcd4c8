"""Deep-shallow sorting of byte strings that share long prefixes, and what it says about repeats."""

import numpy as np

SHALLOW = 48
_STEP = 8


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    return n - ((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() + 7) // 8


def blind_order(strings: list[bytes], members: list[int]) -> list[int]:
    """Members in the order of their strings, by a blind trie: its nodes keep only the depth at which
    strings part. A string goes down by the bytes at those depths, is compared with the one leaf
    it reaches, and is put in where the two part."""
    leaf = lambda i: [strings[i], [i]]
    root = leaf(members[0])
    for i in members[1:]:
        s, node, path = strings[i], root, []
        while type(node) is tuple:
            path.append(node)
            depth, arms = node
            node = arms.get(s[depth] if depth < len(s) else -1) or next(iter(arms.values()))
        other = node[0]
        if s == other:
            node[1].append(i)
            continue
        parts = common_prefix(s, other)
        keep = 0
        while keep < len(path) and path[keep][0] < parts:
            keep += 1
        if keep < len(path) and path[keep][0] == parts:
            path[keep][1][s[parts] if parts < len(s) else -1] = leaf(i)
            continue
        below = path[keep] if keep < len(path) else node
        made = (parts, {other[parts] if parts < len(other) else -1: below,
                        s[parts] if parts < len(s) else -1: leaf(i)})
        if keep == 0:
            root = made
        else:
            depth, arms = path[keep - 1]
            arms[s[depth] if depth < len(s) else -1] = made
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if type(node) is tuple:
            stack += [node[1][c] for c in sorted(node[1], reverse=True)]
        else:
            out += node[1]
    return out


def deep_shallow_order(strings: list[bytes], members: list[int], depth: int = 0, shallow: int = SHALLOW) -> list[int]:
    """Members in the order of their strings: multikey quicksort, eight bytes a step, as far as the
    shallow depth; groups that are still together there go through a blind trie."""
    out, stack = [], [(members, depth)]
    while stack:
        group, d = stack.pop()
        if len(group) == 1:
            out += group
        elif d >= shallow:
            out += blind_order(strings, group)
        else:
            keys = [strings[i][d:d + _STEP] for i in group]
            pivot = keys[len(keys) // 2]
            same = [i for i, k in zip(group, keys, strict=True) if k == pivot]
            if len(same) < len(group):
                more = [i for i, k in zip(group, keys, strict=True) if k > pivot]
                less = [i for i, k in zip(group, keys, strict=True) if k < pivot]
                if more:
                    stack.append((more, d))
                stack.append((same, d + _STEP if len(pivot) == _STEP else shallow))
                if less:
                    stack.append((less, d))
            else:
                stack.append((same, d + _STEP if len(pivot) == _STEP else shallow))
    return out


def matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Zero-padded bytes, (n, width), and lengths."""
    length = np.fromiter(map(len, strings), np.int64, len(strings))
    cells = np.frombuffer(b"".join([s.ljust(width, b"\0") for s in strings]), np.uint8)
    return cells.reshape(len(strings), width), length


def neighbour_prefix(cells: np.ndarray, length: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each string in the order with the one before it; 0 for the first."""
    same = cells[order[1:]] == cells[order[:-1]]
    lcp = np.where(same.all(axis=1), cells.shape[1], same.argmin(axis=1))
    return np.r_[0, np.minimum(lcp, np.minimum(length[order[1:]], length[order[:-1]]))]


def repeated_reach(left: list[bytes], right: list[bytes], groups: list[list[int]], need: int,
                   shared: int) -> tuple[np.ndarray, np.ndarray]:
    """How far before and after its anchor each member is covered by strings of ``need`` bytes that
    another member of its group has at the same offset; (0, 0) without one.

    left: bytes before the anchor, read backwards; right: bytes from the anchor on. Members of a
    group are sorted by either side. For every offset a, two members agree if their left sides
    share a bytes and their right sides ``need`` - a; both are runs of the sorted orders.
    """
    n = len(left)
    before, after = np.zeros(n, np.int64), np.zeros(n, np.int64)
    cells_l, len_l = matrix(left, need - shared)
    cells_r, len_r = matrix(right, need)
    rank_l, rank_r = np.empty(n, np.int64), np.empty(n, np.int64)
    order_l = np.fromiter((i for g in groups for i in deep_shallow_order(left, g)), np.int64, n)
    order_r = np.fromiter((i for g in groups for i in deep_shallow_order(right, g, 0)), np.int64, n)
    first = np.zeros(n, bool)
    first[np.cumsum([0, *map(len, groups)])[:-1]] = True
    lcp_l, lcp_r = neighbour_prefix(cells_l, len_l, order_l), neighbour_prefix(cells_r, len_r, order_r)
    rank_l[order_l], rank_r[order_r] = np.arange(n), np.arange(n)
    open_ = np.arange(n)
    for a in range(need - shared + 1):
        able = open_[(len_l[open_] >= a) & (len_r[open_] >= need - a)]
        if not len(able):
            continue
        class_l = np.cumsum(first | (lcp_l < a))[rank_l[able]]
        class_r = np.cumsum(first | (lcp_r < need - a))[rank_r[able]]
        pair = class_l * (n + 1) + class_r
        by = np.argsort(pair, kind="stable")
        twin = pair[by][1:] == pair[by][:-1]
        met = np.zeros(len(able), bool)
        met[by[1:][twin]] = True
        met[by[:-1][twin]] = True
        hit = able[met]
        before[hit] = a
        after[hit] = np.maximum(after[hit], need - a)
    return before, after
