"""Edit scripts as persistent strings, and the cheapest script of a conversation.

A script is a linked node: its last symbol and the script before it, so that all
scripts of a dynamic programme share their beginnings.  Every node knows its
ancestors 1, 2, 4, ... steps back and a rolling hash of its whole script.  Two
scripts of one cost are compared by searching their longest common prefix over
the ancestors' hashes; equal hashes are verified symbol by symbol down to a
shared node, and what was verified once is remembered."""

from __future__ import annotations

_MOD, _BASE = (1 << 61) - 1, 1_000_003


class Audits:
    """The nodes; 0 is the empty script.  ``hash_of`` may be replaced in tests."""

    def __init__(self, hash_of=hash):
        self.symbol, self.hash, self.up, self.depth = [""], [0], [()], [0]
        self.same_as = {}
        self.hash_of = hash_of
        self.verified = self.collisions = 0

    def add(self, node: int, symbol: str) -> int:
        up = [node]
        while True:
            far = self.up[up[-1]]
            if len(far) < len(up):
                break
            up.append(far[len(up) - 1])
        self.symbol.append(symbol)
        self.hash.append((self.hash[node] * _BASE + self.hash_of(symbol)) % _MOD)
        self.up.append(tuple(up))
        self.depth.append(self.depth[node] + 1)
        return len(self.symbol) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            up = self.up[node]
            node = up[min((self.depth[node] - depth).bit_length(), len(up)) - 1]
        return node

    def _first(self, node: int) -> int:
        """The node that stands for all nodes verified to hold the same script."""
        root = node
        while root in self.same_as:
            root = self.same_as[root]
        while node != root:
            self.same_as[node], node = root, self.same_as[node]
        return root

    def same(self, x: int, y: int) -> bool:
        """Whether two scripts of one depth are equal."""
        if x == y:
            return True
        if self.hash[x] != self.hash[y]:
            return False
        pairs = []
        while True:
            x, y = self._first(x), self._first(y)
            if x == y:
                break
            self.verified += 1
            if self.symbol[x] != self.symbol[y]:
                self.collisions += 1
                return False
            pairs.append((x, y))
            x, y = self.up[x][0], self.up[y][0]
        for x, y in pairs:
            x, y = self._first(x), self._first(y)
            if x != y:
                self.same_as[max(x, y)] = min(x, y)
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether script x, written out, comes before script y."""
        depth = min(self.depth[x], self.depth[y])
        a, b = self.ancestor(x, depth), self.ancestor(y, depth)
        if self.same(a, b):
            return self.depth[x] < self.depth[y]
        for k in range(min(len(self.up[a]), len(self.up[b])) - 1, -1, -1):
            ups = self.up[a], self.up[b]
            if k < min(len(ups[0]), len(ups[1])) and not self.same(ups[0][k], ups[1][k]):
                a, b = ups[0][k], ups[1][k]
        first, second = self.symbol[a], self.symbol[b]
        if first.startswith(second) or second.startswith(first):
            # symbols of several letters: what follows decides
            return self.script(x, self.depth[a] - 1) < self.script(y, self.depth[b] - 1)
        return first < second

    def symbols(self, node: int, depth: int = 0) -> list[str]:
        out = []
        while self.depth[node] > depth:
            out.append(self.symbol[node])
            node = self.up[node][0]
        return out[::-1]

    def script(self, node: int, depth: int = 0) -> str:
        return "".join(self.symbols(node, depth))


# Costs of the edits, and of a truncated row that is not deleted.
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: What has been written so far: nothing, a system row, up to a user's row, up to an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ENDS = 4, (START, ASSISTANT)
#: A row's code: its role's initial (s, u, a, another), 4 if it must go, 8 if it is truncated.
INITIALS = "sua"
GONE, CUT = 4, 8


def _better(audits, best, state, cost, node, letter):
    """Put the script ``node`` + ``letter`` into ``best`` if it beats the one there."""
    old = best[state]
    if old is None or cost < old[0]:
        best[state] = (cost, node, letter)
    elif cost == old[0]:
        new = audits.add(node, letter)
        if old[2]:
            old = (cost, audits.add(old[1], old[2]), "")
            best[state] = old
        if audits.less(new, old[1]):
            best[state] = (cost, new, "")


def _settled(audits, best):
    return [None if b is None else (b[0], audits.add(b[1], b[2]) if b[2] else b[1], "") for b in best]


def with_inserts(audits, best):
    """Rows may be inserted after what was written: a user's first, then an assistant's."""
    best = list(best)
    for state in (START, SYSTEM, ASSISTANT):
        if best[state]:
            _better(audits, best, USER, best[state][0] + INSERT, best[state][1], "I")
    best = _settled(audits, best)
    if best[USER]:
        _better(audits, best, ASSISTANT, best[USER][0] + INSERT, best[USER][1], "I")
    return _settled(audits, best)


def after_rows(audits, best, codes: bytes):
    """The best script per state after some rows (and inserts behind each)."""
    for code in codes:
        initial, kept_cost = code & 3, TRUNCATED if code & CUT else 0
        now = [None] * STATES
        for state, b in enumerate(best):
            if b is None:
                continue
            cost, node, _ = b
            _better(audits, now, state, cost + DELETE, node, "D")
            if code & GONE:
                continue
            role = ASSISTANT if state == USER else USER  # the only role that may follow, but for a first system row
            if initial == 0 and state == START:
                _better(audits, now, SYSTEM, cost + kept_cost, node, "K")
            if initial == role - 1:
                _better(audits, now, role, cost + kept_cost, node, "K")
            _better(audits, now, role, cost + RENAME + kept_cost, node, "R")
        best = with_inserts(audits, _settled(audits, now))
    return best


def cheapest_audit(codes: bytes) -> tuple[int, str]:
    """Cost and script of a whole conversation."""
    audits = Audits()
    best = after_rows(audits, with_inserts(audits, [(0, 0, ""), None, None, None]), codes)
    return min((best[s][0], audits.script(best[s][1])) for s in ENDS if best[s])


def piece_scripts(codes: bytes) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, script) of a stretch of rows."""
    out = []
    for before in range(STATES):
        audits, best = Audits(), [None] * STATES
        best[before] = (0, 0, "")
        for after, b in enumerate(after_rows(audits, best, codes)):
            if b:
                out.append((before, after, b[0], audits.script(b[1])))
    return out


class Pieces:
    """The cheapest scripts of consecutive pieces: a script's symbols are its pieces' scripts."""

    def __init__(self):
        self.audits = Audits()
        root = self.audits
        self.best = [(0, root.add(0, "")), None, (INSERT, root.add(0, "I")), (2 * INSERT, root.add(0, "II"))]

    def append(self, scripts) -> None:
        now = [None] * STATES
        for before, after, cost, script in scripts:
            if self.best[before] is None:
                continue
            total, node = self.best[before]
            new = (total + cost, self.audits.add(node, script))
            old = now[after]
            if old is None or new[0] < old[0] or new[0] == old[0] and self.audits.less(new[1], old[1]):
                now[after] = new
        self.best = now

    def result(self) -> tuple[int, list[str]]:
        """Cost, and the script in front of the rows and of each piece."""
        ends = [self.best[s] for s in ENDS if self.best[s]]
        best = ends[0]
        for e in ends[1:]:
            if e[0] < best[0] or e[0] == best[0] and self.audits.less(e[1], best[1]):
                best = e
        return best[0], self.audits.symbols(best[1])


def edited(script: str, rows, written: int = START):
    """Apply a script: yields (edit, role, row) per letter; ``role`` is None for
    rows that are deleted or keep their role, ``row`` is None for inserts.
    ``written``: the state before."""
    state = written
    rows = iter(rows)
    for letter in script:
        if letter == "D":
            yield letter, None, next(rows)
            continue
        row = None if letter == "I" else next(rows)
        if letter == "K" and state == START and row[0][:1] == "s":
            state = SYSTEM
            yield letter, None, row
            continue
        state = ASSISTANT if state == USER else USER
        role = None if letter == "K" else "assistant" if state == ASSISTANT else "user"
        yield letter, role, row


def state_after(script: str, roles, written: int = START) -> int:
    """Where a script leads that is applied to rows with these roles."""
    state = written
    for letter, _, row in edited(script, ((r,) for r in roles), written):
        if letter != "D":
            state = (SYSTEM if letter == "K" and state == START and row[0][:1] == "s"
                     else ASSISTANT if state == USER else USER)
    return state
