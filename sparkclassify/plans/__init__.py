"""Plans: named queries over the given tables, their oracle SQL, and the
end-to-end jobs."""
