"""Model-input records as array expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """Ids of the four special tokens and of the first byte token."""

    pad: int
    unk: int
    bos: int
    eos: int
    first_byte: int

    @property
    def specials(self) -> dict[str, int]:
        return {"<PAD>": self.pad, "<UNK>": self.unk, "<BOS>": self.bos, "<EOS>": self.eos}


# The three special-id layouts in use.
BYTES_FIRST = Layout(pad=256, unk=257, bos=258, eos=259, first_byte=0)
SPECIALS_FIRST = Layout(pad=0, unk=3, bos=1, eos=2, first_byte=4)
SPECIALS_FIRST_UNK = Layout(pad=0, unk=1, bos=2, eos=3, first_byte=4)


def wrap(ids: Column, layout: Layout) -> Column:
    """BOS ids EOS."""
    return F.concat(F.array(F.lit(layout.bos)), ids, F.array(F.lit(layout.eos)))


def wrap_pair(first: Column, second: Column, layout: Layout) -> Column:
    """BOS first EOS second EOS."""
    eos = F.array(F.lit(layout.eos))
    return F.concat(F.array(F.lit(layout.bos)), first, eos, second, eos)


def pair_segments(first: Column, second: Column) -> Column:
    """Segment 0 for BOS, the first text and its EOS; segment 1 for the rest."""
    return F.concat(
        F.array_repeat(F.lit(0), F.size(first) + 2), F.array_repeat(F.lit(1), F.size(second) + 1)
    )


def pad_to(ids: Column, length: int, layout: Layout, specials: bool = True) -> Column:
    """Truncate the content so the specials survive, wrap, and fill with PAD to `length`."""
    room = length - 2 if specials else length
    cut = F.slice(ids, 1, max(room, 0))
    full = wrap(cut, layout) if specials else cut
    return F.concat(full, F.array_repeat(F.lit(layout.pad), F.greatest(F.lit(length) - F.size(full), F.lit(0))))


def attention_mask(ids: Column, pad: int) -> Column:
    return F.transform(ids, lambda x: F.when(x == pad, F.lit(0)).otherwise(F.lit(1)).cast("bigint"))


def label_ids(ids: Column, pad: int) -> Column:
    """Ids with PAD replaced by the ignored label -1."""
    return F.transform(ids, lambda x: F.when(x == pad, F.lit(-1)).otherwise(x).cast("bigint"))


def model_input(ids: Column, pad: int) -> Column:
    return F.struct(
        F.transform(ids, lambda x: x.cast("bigint")).alias("input_ids"),
        label_ids(ids, pad).alias("labels"),
        attention_mask(ids, pad).alias("attention_mask"),
    )


def next_token_pairs(ids: Column, labels: Column) -> Column:
    """(id at t, label at t+1) for every t but the last."""
    return F.transform(
        F.slice(ids, 1, F.greatest(F.size(ids) - 1, F.lit(0))),
        lambda x, i: F.struct(x.alias("input"), F.get(labels, i + 1).alias("target")),
    )
