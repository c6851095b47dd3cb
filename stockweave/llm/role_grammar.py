"""LR parsing of role sequences with repair: the grammar, its tables, shared stacks, priced edits.

A conversation is ``(s?(ua)+)?`` over the initials of its roles. Its tables are built from the
grammar below. Stacks share their lower parts and equal stacks are one node; after every turn
each node keeps the cheapest way to it, by cost and then by the text of its edits (D, I, K, R).

Costs lie near each other and edits are compared by rank, so the nodes after a turn take few
forms. A form and what a turn makes of it are remembered; a turn then costs one look-up, and
the edits are read back at the end.
"""

from __future__ import annotations

from functools import lru_cache

GRAMMAR = [
    ("Start", ("Conversation",)),
    ("Conversation", ()),
    ("Conversation", ("s", "Pairs")),
    ("Conversation", ("Pairs",)),
    ("Pairs", ("Pairs", "Pair")),
    ("Pairs", ("Pair",)),
    ("Pair", ("u", "a")),
]
END = "$"
SPOKEN = {"u": "user", "a": "assistant"}
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
# Any stack can follow another's edits by deleting one system turn and inserting one turn to keep step
# and a pair at the end. A stack that is dearer than the cheapest by more cannot be on a cheapest way.
HOPELESS = DELETE + 3 * INSERT

Items = frozenset[tuple[int, int]]


class Tables:
    """SLR(1) tables of ``GRAMMAR``: states, shifts and gotos, reductions by next symbol."""

    def __init__(self):
        self.symbols = {left for left, _ in GRAMMAR}
        self.follow = self._follow()
        start = self._closure({(0, 0)})
        self.states, self.moves = [start], {}
        for number, items in enumerate(self.states):
            for symbol in sorted({GRAMMAR[r][1][at] for r, at in items if at < len(GRAMMAR[r][1])}):
                after = self._closure({(r, at + 1) for r, at in items if GRAMMAR[r][1][at : at + 1] == (symbol,)})
                if after not in self.states:
                    self.states.append(after)
                self.moves[number, symbol] = self.states.index(after)
        self.reductions = {
            (number, symbol): r
            for number, items in enumerate(self.states)
            for r, at in items
            if at == len(GRAMMAR[r][1])
            for symbol in self.follow[GRAMMAR[r][0]]
        }
        whole = [(number, *next(iter(items))) for number, items in enumerate(self.states) if len(items) == 1]
        self.finished = {number: r for number, r, at in whole if r and at == len(GRAMMAR[r][1])}

    def _closure(self, items: set[tuple[int, int]]) -> Items:
        found, todo = set(items), list(items)
        while todo:
            rule, at = todo.pop()
            wanted = GRAMMAR[rule][1][at : at + 1]
            new = {(r, 0) for r, (left, _) in enumerate(GRAMMAR) if (left,) == wanted} - found
            found |= new
            todo.extend(new)
        return frozenset(found)

    def _follow(self) -> dict[str, set[str]]:
        """Symbols that may come next. Only ``Conversation`` can be empty, and nothing follows it."""
        first = {symbol: set() for symbol in self.symbols}
        follow = {symbol: set() for symbol in self.symbols}
        follow["Start"].add(END)
        for _ in GRAMMAR:
            for left, right in GRAMMAR:
                first[left] |= first.get(right[0], {right[0]}) if right else set()
                for symbol, after in zip(right, (*right, None)[1:], strict=False):
                    if symbol in follow:
                        follow[symbol] |= follow[left] if after is None else first.get(after, {after})
        return follow


# Nodes after a turn: (node, cost above the least, rank of its edits among the nodes).
Form = tuple[tuple[int, int, int], ...]
# Where the way to a node came from: the node before the turn and the edits since.
Ways = dict[int, tuple[int, str]]
# A turn as the parser sees it: initial of the role, must be deleted, lacks its end.
Turn = tuple[str, bool, bool]


class Stacks:
    """The stacks met so far. Node 0 is the empty stack; the others are a state on a node."""

    def __init__(self):
        self.tables = Tables()
        self.state, self.below = [0], [-1]
        self.known: dict[tuple[int, int], int] = {}
        self.shifts: dict[tuple[int, str], int | None] = {}
        found = [0]
        for node in found:
            found += sorted({n for x in ("s", *SPOKEN) if (n := self.shift(node, x)) is not None} - set(found))
        # All stacks that can stand after a turn. Pairs are reduced as they end, so there are few.
        self.nodes = sorted(found)
        self.accepting = {n for n in found if self.tables.reductions.get((self.state[self._reduced(n, END)], END)) == 0}

    def _push(self, node: int, symbol: str) -> int | None:
        state = self.tables.moves.get((self.state[node], symbol))
        if state is None:
            return None
        key = (state, node)
        if key not in self.known:
            self.known[key] = len(self.state)
            self.state.append(state)
            self.below.append(node)
        return self.known[key]

    def _reduced(self, node: int, symbol: str) -> int:
        """The stack after all reductions that come before ``symbol``."""
        while rule := self.tables.reductions.get((self.state[node], symbol)):
            node = self._replaced(node, rule)
        return node

    def _replaced(self, node: int, rule: int) -> int:
        left, right = GRAMMAR[rule]
        for _ in right:
            node = self.below[node]
        return self._push(node, left)

    def shift(self, node: int, symbol: str) -> int | None:
        """The stack after ``symbol`` and all reductions that no next symbol could change, or None."""
        key = (node, symbol)
        if key not in self.shifts:
            new = self._push(self._reduced(node, symbol), symbol)
            while new is not None and (rule := self.tables.finished.get(self.state[new])):
                new = self._replaced(new, rule)
            self.shifts[key] = new
        return self.shifts[key]


class Repair:
    """Priced edits over shared stacks."""

    def __init__(self):
        self.stacks = Stacks()
        self.after: dict[tuple[Form, Turn], tuple[Form, int, Ways]] = {}

    def _inserted(self, form: Form) -> dict[int, tuple[int, int, str, int]]:
        """Node to (cost, rank, edits since the turn before, node then), inserted turns added."""
        best = {node: (cost, rank, "", node) for node, cost, rank in form}
        todo = list(best)
        while todo:
            node = todo.pop(0)
            cost, rank, edits, origin = best[node]
            for symbol in SPOKEN:
                new = self.stacks.shift(node, symbol)
                way = (cost + INSERT, rank, edits + "I", origin)
                if new is not None and (new not in best or way < best[new]):
                    best[new] = way
                    todo.append(new)
        return best

    def turn(self, form: Form, turn: Turn) -> tuple[Form, int, Ways]:
        """The form after a turn, the cost that all its nodes gained, and the ways taken."""
        known = self.after.get((form, turn))
        if known is None:
            known = self.after[form, turn] = self._turn(form, turn)
        return known

    def _turn(self, form: Form, turn: Turn) -> tuple[Form, int, Ways]:
        initial, must_go, truncated = turn
        best: dict[int, tuple[int, int, str, int]] = {}

        def offer(node: int | None, cost: int, rank: int, edits: str, origin: int) -> None:
            way = (cost, rank, edits, origin)
            if node is not None and (node not in best or way < best[node]):
                best[node] = way

        for node, (cost, rank, edits, origin) in self._inserted(form).items():
            offer(node, cost + DELETE, rank, edits + "D", origin)
            if not must_go:
                extra = TRUNCATED * truncated
                if initial in ("s", *SPOKEN):
                    offer(self.stacks.shift(node, initial), cost + extra, rank, edits + "K", origin)
                for symbol in SPOKEN:
                    offer(self.stacks.shift(node, symbol), cost + extra + REROLE, rank, edits + "R", origin)
        least = min(way[0] for way in best.values())
        best = {node: way for node, way in best.items() if way[0] <= least + HOPELESS}
        # Edits up to here end with a turn taken, so none begins another: rank, then what was added, orders them.
        ranks = {edits: n for n, edits in enumerate(sorted({way[1:3] for way in best.values()}))}
        after = tuple(sorted((node, way[0] - least, ranks[way[1:3]]) for node, way in best.items()))
        return after, least, {node: (way[3], way[2]) for node, way in best.items()}

    def run(self, entry: int, turns: list[Turn]) -> tuple[Form, int, list[Ways]]:
        form, cost, ways = ((entry, 0, 0),), 0, []
        for turn in turns:
            form, gained, way = self.turn(form, turn)
            cost += gained
            ways.append(way)
        return form, cost, ways

    @staticmethod
    def edits(ways: list[Ways], node: int) -> str:
        """The edits that lead to ``node``."""
        parts = []
        for way in reversed(ways):
            node, part = way[node]
            parts.append(part)
        return "".join(reversed(parts))

    def ends(self, form: Form) -> tuple[int, int, int, str]:
        """(cost, rank, node, edits) of the cheapest end, with the turns inserted there."""
        found = [
            (cost, rank, edits, origin)
            for node, (cost, rank, edits, origin) in self._inserted(form).items()
            if node in self.stacks.accepting
        ]
        cost, rank, edits, node = min(found)
        return cost, rank, node, edits

    def spoken(self, entry: int, edits: str, turns: list[Turn]) -> tuple[list[tuple[str | None, int]], int]:
        """What ``edits`` leave: (new role or None, number of the turn or -1), and the stack then.

        A new role is the one that the stack allows; no stack allows both.
        """
        out, node, at = [], entry, 0
        for edit in edits:
            if edit in "IR":
                symbol = next(x for x in SPOKEN if self.stacks.shift(node, x) is not None)
                out.append((SPOKEN[symbol], at if edit == "R" else -1))
                node = self.stacks.shift(node, symbol)
            elif edit == "K":
                out.append((None, at))
                node = self.stacks.shift(node, turns[at][0])
            at += edit != "I"
        return out, node


@lru_cache(1)
def repairs() -> Repair:
    """One per Python worker; what it remembers is bounded by the number of forms."""
    return Repair()
