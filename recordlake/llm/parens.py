"""Trees as balanced parentheses: an opening and a closing one per node, in preorder."""

from __future__ import annotations

import numpy as np

BLOCK = 256


class Parens:
    """``bits`` is true for an opening parenthesis.

    Excess is the number of nodes open after a parenthesis. Blocks of parentheses keep their
    smallest excess, and so do pairs of blocks, pairs of pairs and so on, so the parenthesis
    that closes a node is found without passing over what is inside it.
    """

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(np.where(bits, 1, -1))
        self.opens = np.flatnonzero(bits)
        n_blocks = max(1, -(-len(bits) // BLOCK))
        padded = np.full(n_blocks * BLOCK, len(bits) + 1)
        padded[: len(bits)] = self.excess
        self.least = [padded.reshape(n_blocks, BLOCK).min(1)]
        while len(self.least[-1]) > 1:
            below = self.least[-1]
            if len(below) % 2:
                below = np.append(below, len(bits) + 1)
            self.least.append(below.reshape(-1, 2).min(1))

    def closes(self) -> np.ndarray:
        """Where each node closes, in the order in which they open."""
        wanted = self.excess[self.opens] - 1
        found = np.zeros(len(wanted), np.int64)
        self._scan(np.arange(len(wanted)), self.opens + 1, wanted, found, first=True)
        return found

    def _scan(self, own, at, wanted, found, first):
        """Look inside the block; those that find nothing go on from the next one."""
        on_own, on_at = [], []
        while len(own):
            # The end of a block that was not entered at its beginning ends the look.
            over = (at % BLOCK == 0) & first
            on_own.append(own[over])
            on_at.append(at[over])
            own, at = own[~over], at[~over]
            hit = self.excess[at] <= wanted[own]
            found[own[hit]] = at[hit]
            own, at, first = own[~hit], at[~hit] + 1, True
        left, at = np.concatenate([[], *on_own]).astype(np.int64), np.concatenate([[], *on_at]).astype(np.int64)
        if len(left):
            block = self._next_block(at // BLOCK, wanted[left])
            self._scan(left, block * BLOCK, wanted, found, first=False)

    def _next_block(self, block: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The first block from ``block`` on with an excess as small as wanted."""
        out, level = block.copy(), np.zeros(len(block), np.int64)
        # Up, to the right, until a range holds one.
        todo = np.arange(len(block))
        while len(todo):
            holds = self._least(level[todo], out[todo]) <= wanted[todo]
            todo = todo[~holds]
            out[todo] += 1
            up = todo[out[todo] % 2 == 0]
            out[up] //= 2
            level[up] += 1
        # And down, to the left one if it holds one.
        todo = np.flatnonzero(level)
        while len(todo):
            level[todo] -= 1
            left = 2 * out[todo]
            out[todo] = left + (self._least(level[todo], left) > wanted[todo])
            todo = todo[level[todo] > 0]
        return out

    def _least(self, level, at):
        out = np.empty(len(at), np.int64)
        for k in np.unique(level):
            own = level == k
            out[own] = self.least[k][at[own]]
        return out

    def leaf_rank(self) -> np.ndarray:
        """Leaves that open before each place, one place more than parentheses: a leaf is an
        opening parenthesis and a closing one behind it."""
        leaf = np.zeros(len(self.bits) + 1, np.int64)
        leaf[1:-1] = self.bits[:-1] & ~self.bits[1:]
        return np.cumsum(leaf)
