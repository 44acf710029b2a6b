"""Plans: registered queries, their SQL twins and the five user flows."""
