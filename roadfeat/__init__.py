"""Road-point feature engineering on Spark DataFrames."""

from roadfeat.layer import Layer
from roadfeat.session import build_session

__all__ = ["Layer", "build_session"]
