import datetime

import pytest
from pyspark.sql import functions as F

from pressloom import vocab
from pressloom.functions import dates


@pytest.mark.parametrize("text, found", [
    ("4 de marzo de 2021", [(2021, 3, 4)]), ("1er mars 2021 et 2 août 2020", [(2021, 3, 1), (2020, 8, 2)]),
    ("am 4. März 2021, nicht am 31. Juni 2021", [(2021, 3, 4)]), ("ika-4 ng Marso, 2021", [(2021, 3, 4)]),
    ("Disyembre 25, 2019", [(2019, 12, 25)]), ("Sept. 3rd, 2018 and 3 sept. 2018", [(2018, 9, 3), (2018, 9, 3)]),
    ("marching 4, 2021; smarch 4, 2021; may 2021", []), ("12021-03-04 2021-03-045", []),
    ("15 DÉC 2021", [(2021, 12, 15)]), ("5 del mayo 2021", []), ("10 de enero del 2020", [(2020, 1, 10)]),
])
def test_dates_in_several_languages(values, text, found):
    (got,) = values([(text,)], "t string", dates.date_mentions(F.col("t")))
    assert got == [datetime.datetime(*d) for d in found]


def test_every_month_name_is_read(values):
    rows = [(f"7 {name} 2021", i + 1) for months in vocab.MONTH_NAMES.values() for i, names in enumerate(months) for name in names.split()]
    got = values([(t,) for t, _ in rows], "t string", dates.date_mentions(F.col("t")))
    assert [[d.month for d in g] for g in got] == [[m] for _, m in rows]
