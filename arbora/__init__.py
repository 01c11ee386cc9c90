"""Consensus over subsumption graphs: reading taxonomies, closing and reducing them, voting, ruling, ranking."""
