"""Document operators in plain SQL, worked out independently of the Column expressions."""

from __future__ import annotations

# As Python's text methods have them, not as the Column expressions spell them out.
_BLANKS = [chr(c) for c in range(0x10000) if chr(c).isspace()]
WHITESPACE = "".join(_BLANKS)
LINE_BREAKS = "".join(c for c in _BLANKS if len(f"a{c}b".splitlines()) == 2)
INLINE_SPACE = "".join(c for c in _BLANKS if c not in LINE_BREAKS)

_WORD = r"\p{L}\p{N}_"
_LINE_END = f"\r\n|[{LINE_BREAKS}]"


def strip(text: str) -> str:
    return f"trim({text}, '{WHITESPACE}')"


def clean(text: str) -> str:
    without_blanks = rf"regexp_replace(replace({text}, chr(0), ''), '[ \t]+\n', chr(10), 'g')"
    return strip(rf"regexp_replace({without_blanks}, '\n{{3,}}', chr(10) || chr(10), 'g')")


def redact(text: str) -> str:
    """Without look-around: the characters beside a number are captured and put back.

    Two numbers may share such a character, hence the second pass.
    """
    email = rf"regexp_replace({text}, '[{_WORD}.+-]+@[{_WORD}-]+\.[{_WORD}.-]+', '[REDACTED_EMAIL]', 'g')"
    number = r"0\p{Nd}{1,4}-?\p{Nd}{1,4}-?\p{Nd}{3,4}"
    pattern, label = rf"(^|[^{_WORD}]){number}($|[^{_WORD}])", r"\1[REDACTED_PHONE]\2"
    once = f"regexp_replace({email}, '{pattern}', '{label}', 'g')"
    return f"regexp_replace({once}, '{pattern}', '{label}', 'g')"


def short_hash(text: str) -> str:
    return f"substr(sha256({text}), 1, 32)"


def heading_chunks(source: str, name: str = "heading_chunks") -> str:
    """CTEs giving (id, chunk_index, chunk_text) of a CTE ``source`` with (id, text).

    The depth of a heading is its level, but at most one more than the depth before:
    a running minimum.
    """
    titles = ", ".join(
        f"""last_value(CASE WHEN depth = {level} THEN title END IGNORE NULLS) OVER (
            PARTITION BY id ORDER BY section ROWS UNBOUNDED PRECEDING)"""
        for level in range(1, 7)
    )
    return f"""
        {name}_lines AS (
            SELECT id, unnest(parts) AS line, generate_subscripts(parts, 1) AS line_number
            FROM (SELECT id, string_split_regex(text, '{_LINE_END}') AS parts FROM {source})
        ), {name}_marked AS (
            SELECT *, regexp_matches(line, '^#{{1,6}}[{INLINE_SPACE}]') AS is_heading,
                   length(regexp_extract(line, '^#*')) AS marks
            FROM {name}_lines
        ), {name}_numbered AS (
            SELECT *, count(*) FILTER (is_heading) OVER (
                PARTITION BY id ORDER BY line_number ROWS UNBOUNDED PRECEDING) AS section
            FROM {name}_marked
        ), {name}_headings AS (
            SELECT id, section, {strip("substr(line, marks + 1)")} AS title,
                   section + least(0, min(marks - section) OVER (
                       PARTITION BY id ORDER BY section ROWS UNBOUNDED PRECEDING)) AS depth
            FROM {name}_numbered WHERE is_heading
        ), {name}_paths AS (
            SELECT id, section, array_to_string(list_slice([{titles}], 1, depth), ' > ') AS path
            FROM {name}_headings
        ), {name}_bodies AS (
            SELECT id, section,
                   {strip("string_agg(line, chr(10) ORDER BY line_number)")} AS body
            FROM {name}_numbered WHERE NOT is_heading GROUP BY id, section
        ), {name} AS (
            SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY section) - 1 AS INTEGER)
                       AS chunk_index,
                   CASE WHEN coalesce(path, '') <> '' THEN path || chr(10) || body ELSE body END
                       AS chunk_text
            FROM {name}_bodies LEFT JOIN {name}_paths USING (id, section) WHERE body <> ''
        )
    """


def paragraph_chunks(source: str, name: str = "paragraph_chunks") -> str:
    """Recursive CTEs giving (id, chunk_index, chunk_text) of a CTE ``source`` with
    (id, text, max_chars, overlap)."""
    gap = "chr(10) || chr(10)"
    full = f"length(current) + length(paragraph) + 2 > p.max_chars"
    return rf"""
        {name}_paragraphs AS (
            SELECT id, max_chars, overlap, unnest(parts) AS paragraph,
                   generate_subscripts(parts, 1) AS position, len(parts) AS total
            FROM (
                SELECT id, max_chars, overlap, list_filter(
                    list_transform(string_split_regex(text, '\n[{WHITESPACE}]*\n'),
                                   lambda part: {strip("part")}),
                    lambda part: part <> '') AS parts
                FROM {source})
        ), {name}_packing AS (
            SELECT id, position, total, paragraph AS current, CAST(NULL AS VARCHAR) AS closed,
                   0 AS chunks
            FROM {name}_paragraphs WHERE position = 1
            UNION ALL
            SELECT p.id, p.position, p.total,
                   CASE WHEN {full} THEN right(current, p.overlap) || {gap} || paragraph
                        ELSE current || {gap} || paragraph END,
                   CASE WHEN {full} THEN current END,
                   chunks + CASE WHEN {full} THEN 1 ELSE 0 END
            FROM {name}_packing AS s JOIN {name}_paragraphs AS p
                 ON p.id = s.id AND p.position = s.position + 1
        ), {name} AS (
            SELECT id, chunks - 1 AS chunk_index, {strip("closed")} AS chunk_text
            FROM {name}_packing WHERE closed IS NOT NULL
            UNION ALL
            SELECT id, chunks, {strip("current")} FROM {name}_packing WHERE position = total
        )
    """
