"""Persistent strings of edits: each is a node linked to the one it extends, so common beginnings are shared.

A node keeps its last token, a rolling hash of all tokens up to it, and its ancestors 1, 2, 4, ... steps up.
Two strings of equally many tokens are compared by a search for their longest common prefix over those
ancestors. What the hashes claim equal is verified token by token up to the shared node.
Tokens at one depth are such that none begins another, so their order is the order of the strings.
"""

from __future__ import annotations

from hashlib import blake2b

_PRIME = (1 << 61) - 1
_BASE = 0x1B873593CC9E2D51 % _PRIME
ROOT = 0


class Trail:
    def __init__(self):
        self.token = [""]
        self.up: list[list[int]] = [[]]
        self.hash = [0]
        self._known: dict[str, int] = {}

    def _code(self, token: str) -> int:
        if len(token) > 8:
            return int.from_bytes(blake2b(token.encode(), digest_size=7).digest(), "big") + 1
        if token not in self._known:
            self._known[token] = int.from_bytes(token.encode(), "big") % _PRIME + 1
        return self._known[token]

    def extend(self, node: int, token: str) -> int:
        """A new node: the string of ``node``, then ``token``."""
        up, j = [node], 0
        while j < len(self.up[up[j]]):
            up.append(self.up[up[j]][j])
            j += 1
        self.token.append(token)
        self.up.append(up)
        self.hash.append((self.hash[node] * _BASE + self._code(token)) % _PRIME)
        return len(self.token) - 1

    def less(self, a: int, b: int) -> bool:
        """Whether the string of a is before that of b; both have equally many tokens."""
        if a == b:
            return False
        for j in reversed(range(len(self.up[a]))):
            if j < len(self.up[a]) and self.hash[self.up[a][j]] != self.hash[self.up[b][j]]:
                a, b = self.up[a][j], self.up[b][j]
        # by the hashes a and b are the first tokens that differ; a difference further up would be a collision
        x, y = self.up[a][0], self.up[b][0]
        while x != y:
            if self.token[x] != self.token[y]:
                a, b = x, y
            x, y = self.up[x][0], self.up[y][0]
        return self.token[a] < self.token[b]

    def tokens(self, node: int) -> list[str]:
        out = []
        while node != ROOT:
            out.append(self.token[node])
            node = self.up[node][0]
        return out[::-1]
