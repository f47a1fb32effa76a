"""Payment data-quality and fraud-risk features as Spark jobs."""

from payscope.options import Options
from payscope.plans.assemble import assemble_features
from payscope.operators.families import FAMILIES, family_features
from payscope.session import tune

__all__ = ["FAMILIES", "Options", "assemble_features", "family_features", "tune"]
