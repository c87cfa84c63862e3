"""Plans of operator 10 at the production capacity: known optima, whole use of the pieces, bounded work."""

import random
from collections import Counter

import pytest

from genoweave.llm import packing

CAPACITY = packing.PackParams().capacity


def used(plan):
    out = Counter()
    for times, filling in plan:
        assert times > 0 and sum(x * k for x, k in filling) <= CAPACITY
        for x, k in filling:
            out[x] += k * times
    return out


def solved(lengths):
    plan = packing.plan(Counter(lengths))
    assert used(plan) == Counter(lengths)
    n = packing.sequences(plan)
    assert packing.lower_bound(Counter(lengths), CAPACITY) <= n <= packing.sequences(packing.best_fit_decreasing(Counter(lengths), CAPACITY))
    return n


def perfect(n, seed, parts):
    """Pieces that fill n sequences without waste."""
    r, out = random.Random(seed), []
    while len(out) < n * parts:
        cuts = [r.randint(CAPACITY // parts * 3 // 4, CAPACITY // parts * 3 // 2) for _ in range(parts - 1)]
        if CAPACITY // (parts + 1) < CAPACITY - sum(cuts) < CAPACITY // 2:
            out += [*cuts, CAPACITY - sum(cuts)]
    return out


@pytest.mark.parametrize("n", [10, 30, 100, 300])
def test_perfect_triples(n):
    assert n <= solved(perfect(n, n, 3)) <= n + (n > 30)


@pytest.mark.parametrize("parts", [4, 5])
def test_perfect_fillings_of_more_pieces(parts):
    assert 20 <= solved(perfect(20, parts, parts)) <= 21


def test_three_to_a_sequence():
    """No four of these fit: the bound sees it, so there is nothing to search."""
    r = random.Random(5)
    lengths = [r.randint(1_025, 1_400) for _ in range(300)]
    assert packing.lower_bound(Counter(lengths), CAPACITY) == 100 == solved(lengths)


def test_work_is_bounded():
    r = random.Random(7)
    lengths = [r.randint(1_000, 2_000) for _ in range(3_000)]
    few = packing.PackParams(work=20_000)
    assert used(packing.plan(Counter(lengths), few)) == Counter(lengths)
    assert packing.plan(Counter(lengths), few) == packing.plan(Counter(lengths), few)
    assert used(packing.plan(Counter(lengths), packing.PackParams(work=0))) == Counter(lengths)


@pytest.mark.parametrize("seed", range(40))
def test_fillings_against_all_subsets(seed):
    """Every filling that no other one dominates is enumerated, each once, least waste first."""
    from itertools import combinations

    r, capacity = random.Random(seed), 60
    lengths = sorted(r.randint(3, 40) for _ in range(8))
    stock = packing.Stock(Counter(lengths))
    found = list(packing.fillings(stock, capacity, capacity, packing.Work(10**6)))
    assert [w for w, _ in found] == sorted(w for w, _ in found) and len({f for _, f in found}) == len(found)
    flat = [tuple(sorted(x for x, k in f for _ in range(k))) for _, f in found]
    rest, room = lengths[:-1], capacity - lengths[-1]
    every = {c for n in range(len(rest) + 1) for c in combinations(rest, n) if sum(c) <= room}
    assert {tuple(sorted((*c, lengths[-1]))) for c in every} >= set(flat)
    least = min(room - sum(c) for c in every)
    assert found[0][0] == least
    maximal = {c for c in every if not any(Counter(c) < Counter(d) for d in every)}

    def swapped(c):
        """Whether a piece left over takes the place of one of c, longer, or of two, and still fits."""
        spare, free = sorted((Counter(rest) - Counter(c)).elements()), room - sum(c)
        return any(x < y <= x + free for x in c for y in spare) or any(x + y <= z <= x + y + free for x, y in combinations(c, 2) for z in spare)

    # a piece that fills the room alone stands for all else
    undominated = {tuple(sorted((*c, lengths[-1]))) for c in maximal if not swapped(c) and (room not in rest or c == (room,))}
    assert undominated <= set(flat)


@pytest.mark.parametrize("seed", range(30))
def test_branch_and_bound_is_exact(seed):
    r = random.Random(seed)
    lengths, capacity = [r.randint(10, 60) for _ in range(10)], 100

    def fits(k):
        def go(i, rooms):
            return i == len(lengths) or any(go(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1 :]]) for j in range(k) if rooms[j] >= lengths[i] and rooms[j] not in rooms[:j])

        return go(0, [capacity] * k)

    best = next(k for k in range(1, 11) if fits(k))
    work = lambda: packing.Work(10**7)
    assert packing.branch_and_bound(Counter(lengths), capacity, best - 1, work()) is None
    assert packing.sequences(packing.branch_and_bound(Counter(lengths), capacity, best, work())) == best
