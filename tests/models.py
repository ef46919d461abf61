"""What the text operators must give, in plain Python, one text at a time."""

import re

# What counts as an address, and as a telephone number.
ADDRESS = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+")
NUMBER = re.compile(r"\b0\d{1,4}-?\d{1,4}-?\d{3,4}\b")


def cleaned(text):
    if text is None:
        return ""
    lines = text.replace("\0", "").split("\n")
    # The last line ends without a line break, so its blanks are left to strip().
    trimmed = "\n".join([line.rstrip(" \t") for line in lines[:-1]] + lines[-1:])
    while "\n\n\n" in trimmed:
        trimmed = trimmed.replace("\n\n\n", "\n\n")
    return trimmed.strip()


def masked(text):
    return NUMBER.sub("[REDACTED_PHONE]", ADDRESS.sub("[REDACTED_EMAIL]", text))


def by_heading(text):
    """Sections as (path, body), found from the positions of the headings."""
    lines = (text or "").splitlines()
    marks = {i: re.match(r"#{1,6}(?=\s)", line) for i, line in enumerate(lines)}
    starts = [i for i, mark in marks.items() if mark]
    path, chunks = [], []
    for start, end in zip([None, *starts], [*starts, len(lines)], strict=True):
        if start is not None:
            level = marks[start].end()
            path = [*path[: level - 1], lines[start][level:].strip()]
        body = "\n".join(lines[0 if start is None else start + 1 : end]).strip()
        prefix = " > ".join(path)
        if body:
            chunks.append("\n".join([prefix, body]) if prefix else body)
    return chunks


def by_paragraph(text, limit, overlap):
    packed = []
    for part in filter(None, map(str.strip, re.split(r"\n\s*\n", text or ""))):
        longer = f"{packed[-1]}\n\n{part}" if packed else part
        if not packed:
            packed.append(part)
        elif len(longer) <= limit:
            packed[-1] = longer
        else:
            last = packed[-1]
            packed.append(f"{last[max(0, len(last) - overlap):]}\n\n{part}")
    return [chunk.strip() for chunk in packed]
