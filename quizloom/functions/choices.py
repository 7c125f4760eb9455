"""Multiple-choice options: labels, shuffling, and the answer's new letter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quizloom.functions.once import let


def choice_text(choice: Column) -> Column:
    """What follows the label ``A. `` or ``A) ``; null without one."""
    return F.get(F.split(choice, r"(?<=\A[A-Z])[.)] ", 2), F.lit(1))


def letter(index: Column) -> Column:
    """A for 0, B for 1, ..."""
    return F.chr(index + 65)


def position(answer: Column) -> Column:
    return F.ascii(answer) - 65


def hash_order(texts: Column, key: Column, seed: str) -> Column:
    """The texts in an order that depends on key, place and seed only; a rerun gives the same."""
    keyed = F.transform(texts, lambda t, i: F.struct(F.sha2(F.concat_ws("|", F.lit(seed), key.cast("string"), i.cast("string")), 256).alias("h"), t.alias("t")))
    return F.transform(F.array_sort(keyed), lambda s: s["t"])


def relabel(texts: Column) -> Column:
    return F.transform(texts, lambda t, i: F.concat(letter(i), F.lit(". "), t))


def shuffled(choices: Column, answer: Column, key: Column, seed: str) -> Column:
    """struct<choices, answer>: relabelled options in hash order, and the letter of the first one with the right text.

    Null where an option has no label or the answer names none.
    """
    def moved(texts: Column) -> Column:
        right = F.get(texts, position(answer))
        new = let(hash_order(texts, key, seed), lambda new: F.struct(relabel(new).alias("choices"), letter(F.array_position(new, right).cast("int") - 1).alias("answer")))
        return F.when(named(texts, answer), new)

    return let(F.transform(choices, choice_text), moved)


def named(texts: Column, answer: Column) -> Column:
    """Whether all options have a text and the answer names one."""
    return F.forall(texts, lambda t: t.isNotNull()) & F.get(texts, position(answer)).isNotNull()


def labelled(choices: Column, answer: Column) -> Column:
    """Whether ``shuffled`` gives anything; null choices have none."""
    return F.coalesce(let(F.transform(choices, choice_text), lambda texts: named(texts, answer)), F.lit(False))
