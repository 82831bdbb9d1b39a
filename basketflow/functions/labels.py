"""Labels derived from user attributes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketflow.schemas import ADULT, MIDDLE_AGED, SENIOR, YOUNG


def age_group(age: Column) -> Column:
    """Under 25, 25 to 44, 45 to 64, from 65; null for an unknown age."""
    return (
        F.when(age >= 65, SENIOR)
        .when(age >= 45, MIDDLE_AGED)
        .when(age >= 25, ADULT)
        .when(age.isNotNull(), YOUNG)
    )
