"""KPI families over the star schema. Every function takes a mapping of gold tables."""
