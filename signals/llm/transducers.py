"""Sequential transducers over word classes: each reads a symbol and writes none, one or several.

They are closed under composition, so a cascade becomes one table that reads a
text once. The parts: negation (a few words after a negation turn an insult or
threat into a negated one), reported speech (after a verb of saying, to the end
of the clause or of the quotation), and binding (an insult or threat with a
target shortly before or after it is directed, otherwise bare).
"""

from __future__ import annotations

from collections.abc import Callable

#: Input classes.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END = "other", "insult", "threat", "target", "negation", "report", "quote", "end"
SYMBOLS = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END)

NEGATION_SCOPE = 3  # words after a negation
TARGET_BEFORE, TARGET_AFTER = 4, 3  # words between a target and what it binds
QUOTED_CLAUSES = 4  # a quotation that is never closed ends after so many


class Transducer:
    """``step(state, symbol)`` gives the next state and the symbols written; states are made as they are reached."""

    def __init__(self, start, step: Callable):
        self.start, self.step = start, step

    def __call__(self, symbols) -> list:
        state, out = self.start, []
        for x in symbols:
            state, more = self.step(state, x)
            out += more
        return out

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this one writes."""

        def step(state, symbol):
            mine, theirs = state
            mine, wrote = self.step(mine, symbol)
            out = []
            for x in wrote:
                theirs, more = other.step(theirs, x)
                out += more
            return (mine, theirs), out

        return Transducer((self.start, other.start), step)

    def table(self, symbols=SYMBOLS) -> list[list[tuple[int, tuple]]]:
        """For each reachable state (0 is the start) and symbol, the next state and what is written."""
        number, todo, rows = {self.start: 0}, [self.start], []
        for state in todo:
            row = []
            for x in symbols:
                after, out = self.step(state, x)
                if after not in number:
                    number[after] = len(todo)
                    todo.append(after)
                row.append((number[after], tuple(out)))
            rows.append(row)
        return rows


def negation(scope: int = NEGATION_SCOPE) -> Transducer:
    """State: words left in the scope of a negation."""

    def step(left, x):
        if x == NEGATION:
            return scope, [OTHER]
        if x == END:
            return 0, [END]
        if x == QUOTE:
            return left, [QUOTE]
        return max(left - 1, 0), [f"negated {x}" if left and x in (INSULT, THREAT) else x]

    return Transducer(0, step)


def reported(clauses: int = QUOTED_CLAUSES) -> Transducer:
    """State: "plain", "said" after a verb of saying, or the clauses left in a quotation after one."""

    def step(state, x):
        if x == REPORT:
            return ("said" if state == "plain" else state), [OTHER]
        if x == QUOTE:
            return (clauses if state == "said" else "plain"), []
        if x == END:
            left = state - 1 if isinstance(state, int) else 0
            return left or "plain", [END]
        return state, [f"reported {x}" if state != "plain" and x in (INSULT, THREAT) else x]

    return Transducer("plain", step)


def binding(what: str, before: int = TARGET_BEFORE, after: int = TARGET_AFTER) -> Transducer:
    """``what`` becomes "directed" or "bare"; state: words since a target, words that an unbound one still waits."""
    directed, bare, others = f"directed {what}", f"bare {what}", {f"negated {what}", f"reported {what}"}

    def step(state, x):
        near, waits = state
        if x == TARGET:
            return (before, 0), ([directed] if waits else []) + [x]
        if x == what:
            if near:
                return (near - 1, 0), [directed]
            return (0, after), [bare] if waits else []
        if x == END:
            return (0, 0), ([bare] if waits else []) + [x]
        if x in others:  # written at once, so what waits goes first
            return (max(near - 1, 0), 0), ([bare] if waits else []) + [x]
        return (max(near - 1, 0), max(waits - 1, 0)), ([bare] if waits == 1 else []) + [x]

    return Transducer((0, 0), step)


def grammar() -> Transducer:
    return negation().then(reported()).then(binding(INSULT)).then(binding(THREAT))


#: What the grammar writes of insults and threats: a clause's kinds.
KINDS = tuple(f"{how} {what}" for what in (INSULT, THREAT) for how in ("bare", "directed", "negated", "reported"))
