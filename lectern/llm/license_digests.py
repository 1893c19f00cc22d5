"""SHA-256 digests of the canonical form (licenses.canonical) of whole common licence texts, each without and with its title lines. Fixed values."""

DIGESTS = {
    "Apache-2.0": (
        "13c408416d8b7dcec0d8eb69ad04852da78672036482fc037363f1f25df28a40",
        "4f4efc99b21676427023f964ba9cf67d7063cce2d807400514641d03c8fc64e3",
        "2ad4122a78dc8ed155e0ce71a35466728c88772d2d5c2fc0c7f1c3c4cc792b2b",
        "71f04798c18bedab6f7130c52e48c0ca7d51195d1125db7387572a7f913bc62f",
        "37aa90548985ac0057637d42c3153e8b5d107a21d9556d7fbe60e3e426fdacaa",
        "7f9db88ab222f3a83720a0cb8e72a5cd3771974f45072f9006f35518430df19e",
        "b0599382c8df4042e6943031a45e43201985e794ac50d0d80a9912f187f6da24",
        "dbb777d3ad1fb948fbe99e6748cbd3fea3f269381f3f7efe3f4259a28a9269c9",
        "bf5a5b5f8266da1cefe9cb87de6e4d9451ab96b23b5e979602f1b79340d51ff1",
        "e3920bb81769e42824607184bb7a200116fe5a1d8c9bcbb5b0643618dfca0c82",
        "320a46e6a1c89e2aa0b3742c4c6accc8df37ad9d8f69327e9d276f453c187ed4",
        "b0af5401dd9bbe4e34109b817997a651099f352253ace6abc6b420d4a06c010e",
        "8652df44a515583bb49fe98199858c60d94be49ee97e8069f1de40b61b2f3a0a",
        "9ce71eb31a8abf79414c431def165019f9604548c79edc94fe0d7d50b2f8703e",
        "d915ea366e840df5bd6afef43a63225d77f9be25bd6b632813c6e1a36e3295b8",
        "863bea5f2a16aa20b8a18741a929a245c15332b099db36da9f6dc2fb24ee4cc3",
        "caae487338c528883ec0f0d5fbde8331c3ced00e6db77e7d2c30904163283cae",
        "4a1b9576c9763ea59c42d6ebed84f05c6777a8e71f52d65e673d495908dda537",
    ),
    "BSD-2-Clause": (
        "925e3306eb4a5616de812ebe7636c82195825e66ae2e33f8b7f4a9697c78b03b",
        "326e1c212e3d6ca64decd72383dd96a7f1b1a92af152332406bacff406b88990",
        "ebe0e57739f88ad746c35a14450cf03ce09f19b161284c2877d7444dbc7d6eea",
        "913d8aa2d102c5c4cb97691c9e5a7242f04c06b965528c3af68b8c512facceb3",
        "aa669a220c363e3bb1bf21a89662505aaa4c76977d0a62c6101b26e481c48200",
        "603d586e4e617fb5ea3f5c07854c0a2f20a38a0f2da5bbf9af5861b6876fb7b1",
        "570db0f79e37720922e036f03f2ae67a6f95b4b54da8dce130ee8e82d4f6775a",
        "8027774096368556510a578ff4d19ab28b8072aa988cce24dfe85b7afbee8999",
        "e9cc355b669d642ea9c3b065708c27a04393230e21e383e1bce9f84c45fd79d8",
        "03469208ce47639b2a7cd9911342db5e50fd903d87f5e2cf2186abc10153b4c4",
        "a7dce0d9cea6a0885f23534a7c714cda6a37419cdc63e8a8db6dba9f58cbcda4",
        "7b59af88558a77db02ef62695269a4f55c9c1cc98051d616f35558f3bfcbf872",
        "d03847c0c784e47f89622decd56e955b54bc8e975ffd4d8986652fbfc12f8a19",
        "64441bcf984408c20c6bd97b1d237fd93699424b31e465270537d231228177b7",
    ),
    "BSD-3-Clause": (
        "ab899150d08a3ccf837f742a20fbd8dd108031100312f3224aa5e2d14e0d60f1",
        "18b8c3806553726bfe7a3ec868ea4d82d82dbaed215618da6e21ce04a3e9c1d6",
        "befb3b14a52e89819b52f3b3a57068bb2b8607fe32e649220305ee5f5fb587db",
        "3cc4b16d4d68d72c246398a71b3fe558453198bc652293e000468ff73bd6cfe0",
        "a78d5effa371008bbcd35adcfc5aa0238edbaa6f1d6d82bed83df9b392d9a193",
        "c83425db4ca45b0457085529f65de842efbc5cd5ef58a561c8a0f67bddff8a27",
        "0e03857ea8a808753219da209bd7cf543a271f68c7091f8e6ee0179b665690d6",
        "c22af43035f52c5cbe3e5ecd8791188d34ee0e4c7326a9422c3874a1b364bedc",
        "5f5ef10b23340b3eff7b25df582ec13ea2b0ac90951dcf2bb561072be8c55301",
        "80e928d346053a16374bd8965df8b724bde7813286c7acf4e9c041e405fcddc8",
        "655d2ee52f5931cc9274a1042150ea2a1b5b294950931b4ae9c2e5f515b3dcb8",
        "97b77a3a27c1d04334a25173f50b9d891742641a7de63e879d87ba483aa028e6",
        "14cb57f02d43968781668f4912391a025963cc8eebfc2936b2355509c9a9205b",
        "49e4d161ae424705996a96475c9298080901d47b63eeb77ff0bca405dbad3c67",
        "c068cfac95b6e984727b248136359c85828693bc70293c89cc5573fec568f262",
        "b319478780f8b91a5adaa042becc9f504ddd2205b9c39d8808aa19edb0bd6206",
        "ef6fe619e8097333509a9c0038285c4ad97f27ee88457a76ea63d76365575fa2",
        "38557d055238529d2c48532492fcb5e40cbd13196a2eff2b3ee7dbfc2b5a8ec7",
        "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651",
        "69fcedb70fd1930cb5d773bb71eb605a3aec6362c678302194666d60ca468f71",
        "1b9c2fc92ea32d1c705d689163d6e1783efd910af0262514c4185cad11fefe75",
        "76b173bb2a6492f7941f15493bc75af0a3afc02b9cde5cdc0cad10b180455932",
        "6dd35bce98db3fa45a370b235b582cdcb2284ef2507066048a386c572223f19a",
        "8e5a0986e48de9a9780181128f05245ba36db947f0bc06d5d3141902aea6918e",
        "8604f05715282a03395883d1d7914af0db87a549b46531cb4297d2888fe3739e",
        "6cd2ec4c1707d264427cffd6a4120fb4ce726f221152e3e5c63f8b57d2e1693e",
        "72b1a06b1bd5bde36392094bf4e5144c7a25fe215c30d421928fae268dec4a73",
    ),
    "BSL-1.0": (
        "bc846cfb55dfdb9f8fa410db9fe12d713e37178eadb49ec507680484e5ebe2ac",
        "7442addb08927564a6aefb68009afaa4aadf14d9dc8faaae9539cd1b14a7e5e5",
    ),
    "CC0-1.0": (
        "e3ba2aff64372f535373996fe68b166f9e97dc1ead5b471981213ebb8f310ad6",
        "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
        "a142ae38742c8c4c35f5fa19e0a40ebfa60fc38535daf9c570ca3d7e012e1e32",
    ),
    "GPL-1.0": (
        "6c81984f7c5d611400dbf925ddcb1a71609e417899cbe641f599bfc6492ea189",
        "37f380f152339f34a15db620545eb53f0b5c7d9e6a9542aa09ed0d22f186920f",
    ),
    "GPL-2.0": (
        "fc3d6712a6ac0da538fa47e89c0f1d3d1cf98c373c800e43855371af5f1cca67",
        "ae2be2aaa68f5e52ef402874fc8c7c691879b445cb12e49d84f88168cc2d7dd6",
        "3bf55dc640d4608aa843b2ff9266682c3ebcc2cbd49e25d6701d4eb4279013a4",
        "f88b31b0e1c82a433fc3e8785ae4ec886c7901033caa3185acc088c13ced8ca9",
        "69e9e99315335b0a38c9623e48f2835ba0f22199891311ab9fb0fa252e977dc2",
        "b0eea33c0c3558b8cc58145df00197f77dc3c1649fe13ddfad41d91a51040ef0",
    ),
    "GPL-3.0": (
        "6672609782f640e6bcf82db19d4cb3454a6275f13a230b6bdebd0d38519e151b",
        "ee0d2b91860148fdc6916d4fbea5723c7b0c7330d7a45ee71fabe123ce7175f8",
        "5a1945def56a900c6a74a8a126ac67c343675f1a320357f5070289620e6d32eb",
        "1ca9df986450559c97d78000cfdb4a26875c00b71f04cb55f4abc47ec12d60e2",
    ),
    "LGPL-2.0": (
        "5010f478f2629bcae1cf86997501dcb79f3dd75bccb57bab78a50cfd66161460",
        "bea988245c65edbddad6f43ff12ca2472c232324e916d42648b90eac944d833e",
    ),
    "LGPL-2.1": (
        "387d4f72dfb99bec0f2f2e45a2ccb96eaa2873793acd8de4c9cf44c277be2daa",
        "ed875dac9045cba09a17867210991f3a4a82f80b82096b054560a3a8dae9d692",
        "1431e0ebb36d3e19469bbbed5f773bb02aee72e1277edd3aff82b6ccf7369e7f",
        "b46c8c8aaf296f36bb8838e45376bec939b76249b50bac6ab171dfbb8e896cdd",
    ),
    "LGPL-3.0": (
        "13980739d6423be0921994d8ce3ce547437735b0e6733161f70b19c962f194b7",
        "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    ),
    "MPL-1.1": (
        "b440c5bc32a5f521cc71d2cac4218fadeb81c599798ca23c46d43fbd3276c9de",
        "118b2c814d7e3fa57c85f71b240c6a47d353e8acce9164ed6f28305ba85202b2",
    ),
    "MPL-2.0": (
        "cc0f4adc32bdfbcb84da0472fa08c8a2f97aa7894272c14090e9297ed8e63445",
        "2ae5d4417f09cff2e3412d0e35c4ee2439f6c18ca69d7d9cc799b33614c368a5",
    ),
    "Unlicense": (
        "9ceffc7334827b41e43b88145636107fd3a7ff101b195d3ff37c84c1df553594",
        "150d46e3fe3380718fd7b3ef61555e94d37b2a9de5d646a4f8cd06a8dfdb23dc",
        "a3e52a2e70815e0d5cb6233ba157230192cf34a5a1c90a34fa03708135b1e863",
    ),
}
