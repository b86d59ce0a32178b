"""Sequential models: what one process does, command by command."""


def partition_rule(state, commands):
    """state: {(topic, partition): (offset, metadata, dirty)}; commands in call order."""
    state = dict(state)
    for topic, partition, op, offset, metadata in commands:
        key = (topic, partition)
        if key not in state:
            continue
        current = state[key][0]
        moved = offset + 1 > current if op == "mark" else offset + 1 <= current
        if moved:
            state[key] = (offset + 1, metadata, True)
    return state


def stash_rule(stash, commands):
    """stash: {(topic, partition): (offset, metadata)}."""
    stash = dict(stash)
    for topic, partition, op, offset, metadata in commands:
        key = (topic, partition)
        current = stash.get(key, (0, ""))[0]
        wins = offset >= current if op == "mark" else offset <= current
        if wins:
            stash[key] = (offset, metadata)
    return stash
