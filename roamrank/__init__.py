"""Visit-history recommendations on Spark DataFrames."""

from roamrank.operators.model import AlsConfig, FactorModel
from roamrank.plans.pipeline import Inputs, Outputs, run

__all__ = ["AlsConfig", "FactorModel", "Inputs", "Outputs", "run"]
