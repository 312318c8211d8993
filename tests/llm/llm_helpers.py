def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.select(*names).collect()), key=repr)


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= 2 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(2.0 * sizes[s] for s in over)
        open_ -= over
    return target
