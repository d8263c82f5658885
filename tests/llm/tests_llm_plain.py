"""Plain versions that several tests use."""


def plain_components(rows, percent=85):
    sets = {}
    for i, t, *_ in rows:
        w = [x.decode().translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in (t or "").encode().split()]
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}
