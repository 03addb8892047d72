"""Reading and writing tables, generated domains, and the loads view over the star schema."""
