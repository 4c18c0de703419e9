"""Career ranking on Spark DataFrames: entities, their groups and the groups' regions."""

from debutrank.categories import CATEGORIES, Bonus, Category, Threshold, category

__all__ = ["CATEGORIES", "Bonus", "Category", "Threshold", "category"]
