"""Boolean trigram queries of regular expressions.

``query(pattern)`` is a tuple of alternatives, each a sorted tuple of trigrams that every match must
hold (lower case). ``()`` inside means: no trigram is mandatory, so the rule must scan everything.
The derivation walks Python's own parse of the pattern. It keeps the exact strings of a part while
they are few, and turns them into trigrams where the part ends.
"""

from __future__ import annotations

from itertools import product
from re import _constants as sre
from re import _parser as parser

MOST = 64
ANY = frozenset([frozenset()])


def _fewest(alternatives) -> frozenset:
    """Drops alternatives that another one implies."""
    alternatives = {*alternatives}
    return frozenset(a for a in alternatives if not any(b < a for b in alternatives))


def _both(a: frozenset, b: frozenset) -> frozenset:
    joined = _fewest(x | y for x, y in product(a, b))
    return joined if len(joined) <= MOST else min(a, b, key=len)  # either one alone is still mandatory


def _of(strings) -> frozenset:
    return _fewest(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


def _class(items) -> set | None:
    out: set = set()
    for op, arg in items:
        if op is sre.LITERAL:
            out.add(chr(arg).lower())
        elif op is sre.RANGE and arg[1] - arg[0] < 8:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _walk(nodes) -> tuple[set | None, frozenset]:
    """(all strings that the part can match, or None if too many; its query)."""
    need, run, whole = ANY, {""}, True
    for op, arg in nodes:
        exact, inner = None, ANY
        if op is sre.LITERAL:
            exact = {chr(arg).lower()}
        elif op is sre.IN:
            exact = _class(arg)
        elif op is sre.SUBPATTERN:
            exact, inner = _walk(arg[-1])
        elif op is sre.BRANCH:
            parts = [_walk(p) for p in arg[1]]
            if all(e is not None for e, _ in parts):
                exact = set().union(*(e for e, _ in parts))
            inner = _fewest(x for e, q in parts for x in q)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = arg
            e, q = _walk(body)
            if e is not None and high is not sre.MAXREPEAT and int(high) <= 4 and len(e) ** int(high) <= MOST:
                exact = {"".join(p) for n in range(low, int(high) + 1) for p in product(e, repeat=n)}
            inner = q if low else ANY
        elif op is sre.AT:
            exact = {""}
        if exact is not None and len(exact) * len(run) <= MOST:
            run = {a + b for a in run for b in exact}
        else:
            need, run, whole = _both(_both(need, _of(run)), _both(inner, _of(exact) if exact else ANY)), {""}, False
    return (run if whole else None), _both(need, _of(run))


def query(pattern: str) -> tuple[tuple[str, ...], ...]:
    """OR of ANDs of lower-case trigrams; ``((),)`` where none is mandatory."""
    return tuple(sorted(tuple(sorted(a)) for a in _walk(parser.parse(pattern))[1]))
