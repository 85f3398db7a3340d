"""DuckDB SQL that gives the expected result of each registered plan."""

from tallyhouse.oracles import customers, places, sales, wares

ORACLES: dict[str, str] = {
    **sales.SQL, **customers.SQL, **wares.SQL, **places.SQL
}
