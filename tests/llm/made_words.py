def words(rng, n):
    """Random words, the same for the same generator."""
    return " ".join("".join(rng.choice("abdeilnorst") for _ in range(rng.randint(2, 7))) for _ in range(n))
