"""All query modules; importing this fills the catalogue."""

from tabflow.plans import (  # noqa: F401
    evaluation,
    files,
    monitoring,
    preparation,
    profiling,
    relational,
    sketching,
    streams,
    training,
)
from tabflow.plans.registry import CATALOGUE  # noqa: F401
