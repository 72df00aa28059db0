"""Lightest derivations of items in a weighted hypergraph, after Knuth's generalisation of Dijkstra's algorithm.

Items wait on an agenda in the order of the best weight found for each. The least is final when it is popped, as every deduction
is superior (no consequent weighs less than an antecedent) and monotone (a lighter antecedent never makes a heavier consequent).

Repairs as deductions. An item (i, state) says that i rows are dealt with and the roles so far left the state; its weight is
(cost, audit), compared in this order. Each edit is a deduction that adds its cost and puts its letter at the audit's end, so it
is superior; it is monotone because two audits of one item and equal cost never begin one another: the longer would hold further
insertions, which cost.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable
from dataclasses import dataclass

Item = tuple[int, int]
Weight = tuple[int, str]


def lightest(axioms: Iterable[tuple[Weight, Item]], deduce: Callable[[Item, Weight], Iterable[tuple[Weight, Item]]], goal: Item | None = None) -> dict[Item, Weight]:
    """Final weights of all items that can be derived, or of those popped until the goal is."""
    agenda = list(axioms)
    heapq.heapify(agenda)
    final: dict[Item, Weight] = {}
    while agenda:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        if item == goal:
            break
        for new in deduce(item, weight):
            if new[1] not in final:
                heapq.heappush(agenda, new)
    return final


#: What the roles so far leave open: nothing yet, after a system row, after a user's, after an assistant's.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: The state after a row of this initial, by the state before it.
AFTER = {"s": {BEGIN: SYSTEM}, "u": {BEGIN: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: The state after a user's or an assistant's row, whichever fits.
NEXT = {BEGIN: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5


@dataclass(frozen=True)
class Row:
    """What edits need to know of a row: its role's initial, whether it must go, whether it breaks off."""

    initial: str
    must_go: bool
    truncated: bool


def edits(rows: list[Row], closing: bool) -> Callable[[Item, Weight], list[tuple[Weight, Item]]]:
    """Deductions over rows. Insertions come before a row, or at the very end where `closing` says that no row follows;
    then the goal (len(rows) + 1, BEGIN) holds what ends well."""
    end = len(rows)

    def deduce(item: Item, weight: Weight) -> list[tuple[Weight, Item]]:
        (i, state), (cost, audit) = item, weight
        if i > end:
            return []
        out = []
        if i < end or closing:
            out.append(((cost + INSERT, audit + "I"), (i, NEXT[state])))
        if i == end:
            if closing and state in (BEGIN, ASSISTANT):
                out.append((weight, (end + 1, BEGIN)))
            return out
        row = rows[i]
        out.append(((cost + DELETE, audit + "D"), (i + 1, state)))
        if not row.must_go:
            cost += TRUNCATED if row.truncated else 0
            after = AFTER.get(row.initial, {}).get(state)
            if after is not None:
                out.append(((cost + KEEP, audit + "K"), (i + 1, after)))
            if after != NEXT[state]:
                out.append(((cost + REROLE, audit + "R"), (i + 1, NEXT[state])))
        return out

    return deduce


def repair(rows: list[Row]) -> Weight:
    """The lightest (cost, audit) over a whole conversation."""
    goal = (len(rows) + 1, BEGIN)
    return lightest([((0, ""), (0, BEGIN))], edits(rows, True), goal)[goal]


def through(rows: list[Row], start: int) -> dict[int, Weight]:
    """From a state before a part's rows to each state after them that can be reached; the part's last edit deals with a row."""
    final = lightest([((0, ""), (0, start))], edits(rows, False))
    return {state: final[(len(rows), state)] for state in range(STATES) if (len(rows), state) in final}


def joined(parts: list[list[dict[int, tuple[int, int]]]], start: int) -> dict[int, tuple[int, tuple[int, ...], list[int]]]:
    """Through parts that follow each other: for each last state the cost, the audits' ranks part by part, and the states between.

    parts[k][p][q] is (cost, rank): the lightest way through part k from state p to q, and where its audit stands among those from
    p. Such audits deal with equally many rows and end with one of them, so none begins another, and comparing ranks part by
    part is comparing the audits. A deduction joins a prefix with a way through the next part.
    """

    def deduce(item: Item, weight):
        k, state = item
        if k == len(parts):
            return []
        cost, ranks, states = weight
        return [((cost + c, (*ranks, rank), (*states, q)), (k + 1, q)) for q, (c, rank) in parts[k][state].items()]

    final = lightest([((0, (), (start,)), (0, start))], deduce)
    return {q: final[(len(parts), q)] for q in range(STATES) if (len(parts), q) in final}


def ranked(ways: dict) -> dict:
    """(cost, rank of the second part) instead of (cost, audit or ranks, ...)."""
    order = {audit: i for i, audit in enumerate(sorted(way[1] for way in ways.values()))}
    return {q: (way[0], order[way[1]]) for q, way in ways.items()}


def closed(ways: dict) -> tuple[int, int, str]:
    """(last state, cost, closing insertions) of the lightest way to the end of a conversation."""
    best = None
    for q, (cost, rank) in ways.items():
        more = 0
        state = q
        while state not in (BEGIN, ASSISTANT):
            state, more = NEXT[state], more + 1
        way = ((cost + INSERT * more, rank), (q, cost + INSERT * more, "I" * more))
        best = way if best is None or way < best else best
    return best[1]
