"""Plans: the silver loads (L1-L6), the star schema (G1-G5), exploration (E),
analysis (A), reports (R), and the warehouse build that ties them together."""
