from .files import read_admissions
from .star import star_admissions

__all__ = ["read_admissions", "star_admissions"]
