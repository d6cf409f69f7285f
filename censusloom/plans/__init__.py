from censusloom.plans.build import Build, Inputs, build_levels
from censusloom.plans.storage import clear, settle, shared_folder

__all__ = [n for n in dir() if not n.startswith("_")]
