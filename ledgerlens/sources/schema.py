"""Schemas and codes of card transactions."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSFER_IN, TRANSFER_OUT, WITHDRAWAL, BALANCE, PURCHASE, PAYMENT = "S33", "S25", "S24", "S00", "S22", "S31"
#: Typed features are built for these, in this order.
TYPED = {"transin": TRANSFER_IN, "transout": TRANSFER_OUT, "quxian": WITHDRAWAL, "consume": PURCHASE, "daifu": PAYMENT}
SAME_CITY, OTHER_CITY, CROSS_BORDER = "1", "2", "4"
HOLDER_FAILURES = ("51", "55", "61", "65", "75")
DOMESTIC = "156"
NIGHT_HOURS = (23, 0, 1, 2, 3, 4, 5)

_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


PAIR_EDGES = _schema(out_card=_S, in_card=_S, amount=_D, count=_I)
CARD_DICT = _schema(id=_L, card=_S)
ENCODED_EDGES = _schema(src=_L, dst=_L, amount=_D, count=_I)
PAIR_STATS = _schema(in_card=_S, in_id=_L, out_card=_S, out_id=_L, msum=_D, csum=_I, locsum=_I, foreignsum=_I)
WITHDRAWALS = _schema(card=_S, money=_S, pdate=_S, time=_S, unused=_S, trans_md=_S, cross=_S, mchnt_cd=_S, term_id=_S)
MD5_CARD = _schema(oricard=_S, md5card=_S)
