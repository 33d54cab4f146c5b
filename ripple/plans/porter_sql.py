"""The stemmer's rules as DuckDB SQL: one common table expression per step over distinct words."""

from __future__ import annotations

from ripple.functions.porter import STEP_2, STEP_3, STEP_4


def _shape(word: str) -> str:
    """The word as V and c, letter by letter; the shape of a beginning is the beginning of the shape."""
    return (f"list_reduce(list_prepend('', string_split({word}, '')), lambda a, x: a || CASE WHEN contains('aeiou', x) "
            f"OR (x = 'y' AND right(a, 1) = 'c') THEN 'V' ELSE 'c' END)")


def _stem(cut: int) -> str:
    return f"left(w, length(w) - {cut})"


def _of_stem(cut: int) -> str:
    return f"left(sh, length(w) - {cut})"


def _measure(shape: str) -> str:
    return f"((length({shape}) - length(replace({shape}, 'Vc', ''))) // 2)"


def _rules(rules: dict[str, str], condition: str) -> str:
    """The longest suffix that a word ends with decides, whether or not its condition holds."""
    cases = []
    for suffix in sorted(rules, key=len, reverse=True):
        n = len(suffix)
        holds = condition.format(measure=_measure(_of_stem(n)))
        if suffix == "ion":
            holds += f" AND right({_stem(n)}, 1) IN ('s', 't')"
        cases.append(f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {holds} THEN {_stem(n)} || '{rules[suffix]}' ELSE w END")
    return f"CASE {' '.join(cases)} ELSE w END"


def stems(words: str, name: str = "stems") -> list[str]:
    """CTEs that end in ``name`` (word, stem), from a table ``words`` with distinct values in a column ``word``."""
    b, sb = "b", "left(sh, length(b))"
    steps = [
        f"""p0 AS (SELECT word, CASE WHEN length(word) < 3 THEN word WHEN ends_with(word, 'sses') OR ends_with(word, 'ies')
              THEN left(word, length(word) - 2) WHEN ends_with(word, 's') AND NOT ends_with(word, 'ss')
              THEN left(word, length(word) - 1) ELSE word END AS w FROM {words})""",
        f"p1 AS (SELECT word, w, {_shape('w')} AS sh FROM p0)",
        f"""p2 AS (SELECT word, w, sh, CASE WHEN ends_with(w, 'eed') THEN NULL
              WHEN ends_with(w, 'ed') AND contains({_of_stem(2)}, 'V') THEN {_stem(2)}
              WHEN ends_with(w, 'ing') AND contains({_of_stem(3)}, 'V') THEN {_stem(3)} END AS b FROM p1)""",
        f"""p3 AS (SELECT word, CASE
              WHEN ends_with(w, 'eed') AND {_measure(_of_stem(3))} > 0 THEN {_stem(1)}
              WHEN b IS NULL THEN w
              WHEN ends_with(b, 'at') OR ends_with(b, 'bl') OR ends_with(b, 'iz') THEN b || 'e'
              WHEN length(b) > 1 AND right(b, 1) = left(right(b, 2), 1) AND right({sb}, 1) = 'c' AND right(b, 1) NOT IN ('l', 's', 'z')
                THEN left(b, length(b) - 1)
              WHEN {_measure(sb)} = 1 AND ends_with({sb}, 'cVc') AND right(b, 1) NOT IN ('w', 'x', 'y') THEN b || 'e'
              ELSE b END AS w FROM p2)""",
        f"p4 AS (SELECT word, w, {_shape('w')} AS sh FROM p3)",
        f"""p5 AS (SELECT word, CASE WHEN ends_with(w, 'y') AND contains({_of_stem(1)}, 'V') THEN {_stem(1)} || 'i' ELSE w END AS w FROM p4)""",
    ]
    for i, (rules, condition) in enumerate(((STEP_2, "{measure} > 0"), (STEP_3, "{measure} > 0"),
                                            (dict.fromkeys(STEP_4, ""), "{measure} > 1"))):
        steps.append(f"q{i} AS (SELECT word, w, {_shape('w')} AS sh FROM {'p5' if i == 0 else f'r{i - 1}'})")
        steps.append(f"r{i} AS (SELECT word, {_rules(rules, condition)} AS w FROM q{i})")
    steps += [
        f"t0 AS (SELECT word, w, {_shape('w')} AS sh FROM r2)",
        f"""t1 AS (SELECT word, CASE WHEN ends_with(w, 'e') AND ({_measure(_of_stem(1))} > 1 OR ({_measure(_of_stem(1))} = 1
              AND NOT (ends_with({_of_stem(1)}, 'cVc') AND right({_stem(1)}, 1) NOT IN ('w', 'x', 'y')))) THEN {_stem(1)} ELSE w END AS w FROM t0)""",
        f"t2 AS (SELECT word, w, {_shape('w')} AS sh FROM t1)",
        f"""{name} AS MATERIALIZED (SELECT word, CASE WHEN length(word) < 3 THEN word
              WHEN ends_with(w, 'll') AND {_measure('sh')} > 1 THEN {_stem(1)} ELSE w END AS stem FROM t2)""",
    ]
    return steps
