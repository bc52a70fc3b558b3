"""Public license notices as templates of the license scan, and the phrases that name a license outright."""

from __future__ import annotations

from typing import NamedTuple


class Template(NamedTuple):
    """A notice. ``needs``: words a block must hold; ``without``: words of a different license, which it must not."""

    label: str
    text: str
    needs: tuple[str, ...] = ()
    without: tuple[str, ...] = ()


#: Phrases whose words, standing consecutively, name a license.
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]

_GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public "
        "License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
        "later version.")
_GPL_WORK = "This work is licensed under the GNU {kind}General Public License, version {version}."
_CC = "This work is licensed under a Creative Commons Attribution{kind} {version} International License."

#: Wording of public license notices.
TEMPLATES = [
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
             "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
             "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
             "this permission notice shall be included in all copies or substantial portions of the Software."),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
             "compliance with the License. You may obtain a copy of the License at", needs=("apache",)),
    Template("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
             "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
             "License for the specific language governing permissions and limitations under the License."),
    Template("bsd-2", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
             "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
             "list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
             "distribution.", without=("endorse",)),
    Template("bsd-3", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
             "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
             "list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
             "distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
             "promote products derived from this software without specific prior written permission.", needs=("endorse",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies.", needs=("fee",)),
    *(Template(f"{name}-{v}", text.format(kind=kind, version=v), needs=("gnu", str(v), *(() if name == "gpl" else (kind.lower().strip(),))),
               without=("lesser", "affero") if name == "gpl" else ())
      for name, kind, versions in (("gpl", "", (2, 3)), ("lgpl", "Lesser ", (3,)), ("agpl", "Affero ", (3,)))
      for v in versions for text in (_GPL, _GPL_WORK)),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
             "not distributed with this file, You can obtain one at", needs=("mozilla",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
             "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
             "purpose, commercial or non-commercial, and by any means."),
    *(Template(f"cc-by{short}", _CC.format(kind=kind, version=v), needs=tuple(words), without=tuple({"noncommercial", "sharealike", "noderivatives"} - set(words)))
      for short, kind, words in (("", "", ()), ("-nc", "-NonCommercial", ("noncommercial",)), ("-sa", "-ShareAlike", ("sharealike",)),
                                 ("-nd", "-NoDerivatives", ("noderivatives",)),
                                 ("-nc-sa", "-NonCommercial-ShareAlike", ("noncommercial", "sharealike")),
                                 ("-nc-nd", "-NonCommercial-NoDerivatives", ("noncommercial", "noderivatives")))
      for v in ("4.0",)),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]
