"""Transports with fixed pages, for examples and tests."""

from quillgraph.sources.paged import Page


class FivePages:
    """Five pages of three rows; the third page fails the first time it is fetched."""

    failed: set[str] = set()

    def __init__(self, options: dict[str, str]):
        pass

    def fetch(self, token: str) -> Page:
        n = int(token or 0)
        if n == 2 and "2" not in self.failed:
            self.failed.add("2")
            raise ConnectionError("try again")
        return Page([(str(n), r) for r in range(3)], str(n + 1) if n < 4 else "", 15)


class DatedPages:
    """A page for each month of the range, from..until, which are months of one year."""

    def __init__(self, options: dict[str, str]):
        self.start, self.until = int(options["from"]), int(options["until"])

    def fetch(self, token: str) -> Page:
        n = int(token or self.start)
        return Page([(n, f"{n}/{r}") for r in range(2)], str(n + 1) if n < self.until else "", 2 * (self.until - self.start + 1))
