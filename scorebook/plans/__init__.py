from scorebook.plans.arrivals import build_arrivals
from scorebook.plans.incremental import BuildResult, archive, build, build_folder

__all__ = ["BuildResult", "archive", "build", "build_arrivals", "build_folder"]
