"""The record rules in plain Python, to compare the Spark jobs with."""


def blocks_of(path, keep_unterminated=True):
    """Non-empty blocks of a file as lists of stripped lines."""
    blocks, current = [], []
    with open(path, encoding="utf-8") as file:
        for line in file:
            line = line.strip()
            if line:
                current.append(line)
            elif current:
                blocks.append(current)
                current = []
    if current and keep_unterminated:
        blocks.append(current)
    return blocks


def records_of(path):
    """(id, tags, texts) of the blocks that have a tag line."""
    return [(b[0], b[1].split(), b[2:]) for b in blocks_of(path) if len(b) >= 2]
