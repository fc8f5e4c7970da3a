"""Writing matchings (A4).

NULL means "unmatched" inside the engine; the text form writes -1 for it, as
the reference's output did.  Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duetto.names import DOCTOR, HOSPITAL
from duetto.operators.joins import matching_with_unmatched


def write_matching(matching: DataFrame, path: str, doctors: DataFrame | None = None,
                   fmt: str = "parquet") -> None:
    """Write a matching.

    ``parquet``: the matching's columns as they are (NULL = unmatched when
    ``doctors`` is given).  ``text``: one ``doctor_id hospital_id`` line per
    doctor in doctor order, -1 for unmatched doctors (needs ``doctors``).
    """
    if fmt == "parquet":
        out = matching
        if doctors is not None:
            out = doctors.select(DOCTOR).join(matching, DOCTOR, "left")
        out.write.mode("overwrite").parquet(path)
    elif fmt == "text":
        if doctors is None:
            raise ValueError("text output lists every doctor: pass doctors")
        full = matching_with_unmatched(doctors, matching)
        (full.orderBy(DOCTOR)
         .select(F.concat_ws(" ", F.col(DOCTOR).cast("string"),
                             F.col(HOSPITAL).cast("string")).alias("value"))
         .write.mode("overwrite").text(path))
    else:
        raise ValueError(f"unknown format {fmt!r}")
