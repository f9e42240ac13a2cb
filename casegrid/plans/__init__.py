"""Plans: the warehouse build and the catalogue of queries on driver tables."""
