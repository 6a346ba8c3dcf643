"""Brute-force helpers of the tests."""


def components_of(nodes, links):
    up = {i: i for i in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in up}
