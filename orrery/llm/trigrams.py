"""Boolean trigram queries of regular expressions.

What strings a pattern must contain is read off its parse tree: a literal is
itself, a sequence concatenates, an alternative takes either.  A required string
becomes the conjunction of its trigrams, alternatives the disjunction.  A query is
a nested tuple ("and" | "or", parts), a trigram, or None where the pattern
requires none (then every text is a candidate).  Everything is in lower case, as
the index is.
"""

from __future__ import annotations

from re import _constants as C
from re import _parser

#: So many alternatives of a required string are kept apart.
MOST = 64

Query = str | tuple | None


def _and(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _or(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    plain = {p: {p} if isinstance(p, str) else set(p[1]) for p in parts if isinstance(p, str) or p and p[0] == "and"}
    # what asks for all that another part asks for, and more, adds nothing
    parts = [p for p in parts if p not in plain or not any(other < plain[p] for other in plain.values())]
    return None if not parts or None in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _required(strings: set[str]) -> Query:
    """That one of the strings occurs."""
    return _or([_and([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _read(nodes: _parser.SubPattern | list) -> tuple[set[str] | None, Query]:
    """(all strings the nodes can match, if they are few; what else they require)."""
    exact: set[str] | None = {""}
    whole, needs = True, []
    for op, arg in nodes:
        found, need = _node(op, arg)
        needs.append(need)
        if found is not None and len(exact) * len(found) <= MOST:
            exact = {a + b for a in exact for b in found}
        else:
            needs.append(_required(exact))
            whole, exact = False, found if found is not None and len(found) <= MOST else {""}
    if whole:
        return exact, _and(needs)
    return None, _and([*needs, _required(exact)])


def _node(op: int, arg: object) -> tuple[set[str] | None, Query]:
    if op is C.LITERAL:
        return {chr(arg).lower()}, None
    if op is C.IN:
        chars = {chr(a).lower() for o, a in arg if o is C.LITERAL}
        return (chars, None) if all(o is C.LITERAL for o, _ in arg) else (None, None)
    if op is C.SUBPATTERN:
        return _read(arg[3])
    if op is C.BRANCH:
        read = [_read(b) for b in arg[1]]
        if all(e is not None for e, _ in read):
            return set().union(*(e for e, _ in read)), _or([n for _, n in read])
        return None, _or([_and([n, _required(e)]) if e is not None else n for e, n in read])
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        low, high, inner = arg
        exact, need = _read(inner)
        if exact is not None and (low, high) == (0, 1):
            return exact | {""}, None
        if exact is not None and low == high and low and len(exact) ** low <= MOST:
            out = {""}
            for _ in range(low):
                out = {a + b for a in out for b in exact}
            return out, need
        return None, _and([need, _required(exact) if exact is not None else None]) if low else None
    return ({""}, None) if op in (C.AT, C.ASSERT, C.ASSERT_NOT) else (None, None)


def query(pattern: str) -> Query:
    """The trigram query of a pattern in the syntax that Python and Java share."""
    exact, need = _read(_parser.parse(pattern))
    return _and([need, _required(exact)]) if exact is not None else need


def grams(q: Query) -> set[str]:
    return set() if q is None else {q} if isinstance(q, str) else set().union(*(grams(p) for p in q[1]))
