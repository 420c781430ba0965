"""Plain loops that the operators are compared with."""


def tokens(text, keywords):
    """Take the leftmost keyword of the rest, the last one listed if several begin there."""
    found, rest = [], text
    while True:
        places = [(rest.find(kw), -i) for i, kw in enumerate(keywords) if kw in rest]
        if not places:
            return found
        place, order = min(places)
        found.append(keywords[-order])
        rest = rest[place + len(keywords[-order]):]


def contained(text, keywords):
    return sorted({kw for kw in keywords if kw in text})
