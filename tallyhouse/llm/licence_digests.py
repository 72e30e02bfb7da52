"""Digests of the canonical whole texts of licences that are too long to be kept as text.

Made by `licenses.canonical` from the files of /usr/share/common-licenses, each whole and without its closing
appendix, exhibits or (CC0) disclaimer. A change of `canonical` needs new ones.
"""

TEXT_DIGESTS = (
    ("Apache-2.0", "1f4643d36daf75c508f42e320163a4a5882918a117f30420f586dd06acee5c09"),
    ("Apache-2.0", "d7e5909a2057663aa7b58660b74d4e2b7737855fcad01ed39d74a57bfff6514c"),
    ("Apache-2.0", "c2e95064ee2ecaa98448a6d5b7b1170e6b831fd36d85be827b5f02e133c8bbb5"),
    ("GPL-1.0", "6c4bc98bd65d3fcebacd77b2870f9cc296f9bf4add0e7baf975b6d183f211e86"),
    ("GPL-1.0", "9679cb8f8a7c25e849b925136d793d1bec010b8b9270e6ba898e2cefcb3e1f6d"),
    ("GPL-1.0", "37a8d6ceffb74a4cd60be1028e4d7d9cc0b1682c4aa3c1d9efd628dc5460f60b"),
    ("GPL-2.0", "17bc27c667a8d82915bb74a167975daaa34a72ef983dffc60903e06b043338ba"),
    ("GPL-2.0", "34cacbc5d4c8288f220e8dfade5276e6f76704f67150b4388c9ed3e3ff88cd90"),
    ("GPL-2.0", "f1412332f5361d2a392bb637c3844ed3a32b7d701ac0e7abacce50b34a9a3afb"),
    ("GPL-3.0", "268bf429f6ac9178f76ee0ff62011d15ca6c36950a2dd41ae980fc96ed43eff8"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("LGPL-2.0", "cf38cfc729861170868078065b856d3242fe7a850766def057d000a16c81b436"),
    ("LGPL-2.0", "96c47047421b3be5cae9a68c75f37fdcf07945fba0a1d6db6a3b57f9c70f75a0"),
    ("LGPL-2.0", "3c503e1843d56bee44590ba959b2a745cf954688aa5dd285043d139d8c3e6cd6"),
    ("LGPL-2.1", "9862e738f315d8a5309bc010439dcb015ff90374b4007a59d5b00e12f9642e8f"),
    ("LGPL-2.1", "a6742add8db4ff9ba6917da0bd1f95927436acfd65ae81933f1e9a859d38d9fa"),
    ("LGPL-2.1", "d00d08192018b2217de04b223449941a18a7cb07d0c025393948065a12eb0fb2"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-2.0", "0c96bb2878837dea27e4aa19d1516a3297ffbc7e5555a397b86617e477b7057e"),
    ("MPL-2.0", "075fcdf87448c49dbad8c5f7963f0eb6907a3d8eae1b431ba2988508499ec0de"),
    ("MPL-2.0", "5bdd4e4c0894523a3010a3fbd1f1552cf4c58091a590b3f3b164aeaab3933766"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("CC0-1.0", "a142ae38742c8c4c35f5fa19e0a40ebfa60fc38535daf9c570ca3d7e012e1e32"),
    ("CC0-1.0", "7ea83353f6a48443a673f3c4eb58917fd6c45b5b9322ba1c20fbbee6cfc5d526"),
    ("CC0-1.0", "471f66547bc4cdf104c87ac5a818b67290c55a6942ec3d079c1554eb5a6d7664"),
)
