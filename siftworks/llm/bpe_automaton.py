"""A deterministic tokenization automaton compiled from BPE merges.

The automaton reads tokens. It starts as one state with an arc for every base symbol. Each merge (u, v), in rank order,
adds one gadget: the target of u's arcs is copied without its arc v, u's arcs are moved to the copy, and every state
with an arc u gains an arc uv that leads where v led. So the state reached depends on the last token alone, each merge
makes at most one new state, and the automaton accepts exactly one segmentation of any symbol sequence: the one that
applying the merges gives. Arc sets overlap almost wholly between states, so the table keeps, for each state, the label
whose arcs it is a copy of, since which merge, and which arcs were taken off; `arc` reads them and the answers fill the
transition table.

This holds for proper merge lists, under which the spelling of every token encodes to that token alone; `improper` names
those that don't, and such lists are to be refused.

Encoding walks a word along a trie of token spellings, taking of the arcs that leave the last token's state the longest
first. Each prefix has one accepted path at most, so no position is entered twice, and the walk is linear in the word
however often it turns back from arcs that the table hasn't got. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

#: Stands for the end-of-word suffix inside spellings; byte-level symbols never include it.
END = "\n"
_NEVER = 1 << 60
#: Transitions that are kept at once.
MOST_ARCS = 300_000


class Automaton:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end_of_word: str = ""):
        self.suffix = end_of_word
        ids = {self._spelling(t): i for t, i in vocab.items()}
        self.labels = {i: t for t, i in vocab.items()}
        self.rank: dict[int, int] = {}
        self.pair: dict[int, tuple[int, int]] = {}
        self.since: dict[int, int] = {i: -1 for i in ids.values()}  # the merge whose gadget made a label
        self.taken: dict[tuple[int, int], int] = {}  # (u, v): the merge whose gadget took arc v off u's state
        self.table: dict[int, dict[int, bool]] = {i: {} for i in ids.values()}
        self.filled = 0
        self._at: dict[tuple[int, int, int], bool] = {}
        self.live: list[bool] = []
        for k, (a, b) in enumerate(merges):
            self._gadget(k, ids[self._spelling(a)], ids[self._spelling(b)], ids[self._spelling(a) + self._spelling(b)])
        self.base = {t: i for t, i in ids.items() if i not in self.pair}
        self.of_pair = {p: i for i, p in self.pair.items()}
        self.trie = self._trie(ids)

    def _spelling(self, token: str) -> str:
        return token[: -len(self.suffix)] + END if self.suffix and token.endswith(self.suffix) else token

    def _gadget(self, k: int, u: int, v: int, uv: int) -> None:
        """Merge k: arcs u lead to a copy that lacks v from now on; uv is born, leading where v led until now."""
        self.live.append(True)
        if uv in self.pair or (u, v) in self.taken:
            self.live[k] = False  # a second way to spell a token, or a merge that stands twice, never applies
            return
        self.taken[u, v] = k
        self.pair[uv] = (u, v)
        self.since[uv] = k

    def _trie(self, ids: dict[str, int]) -> dict:
        """Nodes are maps from a symbol to [token that ends there or -1, node below]."""
        root: dict = {}
        for text, i in ids.items():
            node = root
            for c in text[:-1]:
                node = node.setdefault(c, [-1, {}])[1]
            node.setdefault(text[-1], [-1, {}])[0] = i
        return root

    def arc(self, state: int, token: int) -> bool:
        """Whether the state after token `state` has an arc `token` once all merges are in."""
        row = self.table[state]
        if (known := row.get(token)) is None:
            self.filled += 1
            if self.filled > MOST_ARCS:  # the table is worked out anew where it is needed
                self.filled = 0
                for r in self.table.values():
                    r.clear()
            known = row[token] = self._present(state, token, _NEVER)
        return known

    def _present(self, w: int, t: int, before: int) -> bool:
        """Whether t leaves w's state in the automaton of the merges below `before`."""
        key = (w, t, before)
        if (known := self._at.get(key)) is not None:
            return known
        self._at[key] = out = self._look(w, t, before)
        if len(self._at) > MOST_ARCS:
            self._at.clear()
        return out

    def _look(self, w: int, t: int, before: int) -> bool:
        born = self.since[t]
        if born >= before:
            return False
        if t in self.pair:
            a, b = self.pair[t]
            if not self._present(w, a, born) or (a == b and self._copied_from(w, born) == a):
                return False
        # w's state goes back along the right parts of w: each was the state in use between its birth and the next
        x, until = w, before
        while True:
            taken = self.taken.get((x, t))
            if taken is not None and max(self.since[x], born) < taken < until:
                return False
            if x not in self.pair:
                return True
            until = min(until, self.since[x])
            x = self.pair[x][1]

    def _copied_from(self, w: int, k: int) -> int:
        """The label whose state w's state goes back to at merge k, -1 if merge k itself parts them."""
        x, until = w, _NEVER
        while not self.since[x] < k:
            if x not in self.pair:
                return -1
            until, x = self.since[x], self.pair[x][1]
        return x if k < until else -1

    def encode(self, symbols: str) -> list[int]:
        """Token ids of one pre-split word, spelt in base symbols."""
        return self._walk(symbols + END if self.suffix else symbols) if symbols else []

    def improper(self) -> list[str]:
        """Tokens of merges whose own spelling merges to something else, found by merging it."""
        return [self.labels[i] for i in self.pair if self._merged(self._spelling(self.labels[i])) != [i]]

    def _merged(self, text: str) -> list[int]:
        """What applying the merges in rank order, each from the left, gives."""
        out = [self.base[c] for c in (text if not text.endswith(END) else [*text[:-2], text[-2:]])]
        while len(out) > 1:
            first = min(((self.taken.get(pair, _NEVER), pair) for pair in zip(out, out[1:])), key=lambda x: x[0])
            if first[0] == _NEVER:
                break
            made, i = [], 0
            while i < len(out):
                if tuple(out[i:i + 2]) == first[1]:
                    made.append(self.of_pair[first[1]])
                    i += 2
                else:
                    made.append(out[i])
                    i += 1
            out = made
        return out

    def _walk(self, text: str) -> list[int]:
        n, trie, table = len(text), self.trie, self.table
        path: list[int] = []
        ends: list[int] = []
        choices: list[list[tuple[int, int]]] = []
        at, arcs = 0, None
        while True:
            node, found, to = trie, [], at
            for c in text[at:]:
                below = node.get(c)
                if below is None:
                    break
                to += 1
                token, node = below
                if token >= 0:
                    found.append((token, to))
            choices.append(found)
            while True:
                found = choices[-1]
                step = None
                while found:
                    token, to = found.pop()
                    if arcs is not None:
                        known = arcs.get(token)
                        if not (self.arc(path[-1], token) if known is None else known):
                            continue
                    step = to
                    break
                if step is not None:
                    break
                choices.pop()
                if not path:
                    raise ValueError(f"no path spells {text!r}")
                path.pop()
                ends.pop()
                arcs = table[path[-1]] if path else None
            path.append(token)
            if step == n:
                return path
            ends.append(step)
            at, arcs = step, table[token]

    def decode(self, ids: list[int]) -> list[str]:
        return [self.labels[i] for i in ids]
