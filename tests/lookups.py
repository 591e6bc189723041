"""A lookup as a user would name it on the command line."""

import pandas as pd


def octets(addresses: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"city": addresses.str.split(".").str[0]})
